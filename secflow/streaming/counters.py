"""Counters that live across micro-batches.

``BatchCounter`` applies the batch operator to each micro-batch together with the few hits still
open from earlier ones, so a hot key is spread over the cluster like in batch. ``stateful_fires``
keeps the open hits in the state store, one key per task, for streams whose keys are moderate.
Across micro-batches hits count in order of arrival, within one in order of time and event id.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from secflow.operators.threshold import fire_marks
from secflow.plans.physical import broadcast_if_bounded


class BatchCounter:
    """Threshold counter for ``foreachBatch``.

    The open hits after batch i are stored as version i, at most n - 1 per key. A replayed batch
    reads version i - 1 again and rewrites version i, so its fires come out the same.
    """

    def __init__(self, state_path: str, key: str, ts: str, event: str, n: str = "n", seconds: str = "seconds",
                 mode: str = "cumulative"):
        self.state_path, self.key, self.ts, self.event = state_path, key, ts, event
        self.n, self.seconds, self.mode = n, seconds, mode

    def _version(self, batch_id: int) -> str:
        return f"{self.state_path}/version={batch_id}"

    def fires(self, hits: DataFrame, batch_id: int, watermark: datetime | None = None) -> DataFrame:
        """Hits that fire in this batch.

        ``watermark`` promises that no later hit lies at or before it; open hits of modes with a time
        limit that no later hit can reach are then dropped, so that idle keys leave the state.
        """
        spark = hits.sparkSession
        rows = hits.withColumn("_carried", F.lit(False))
        if batch_id > 0:
            open_hits = spark.read.schema(hits.schema).parquet(self._version(batch_id - 1))
            rows = open_hits.withColumn("_carried", F.lit(True)).unionByName(rows)
        marked = fire_marks(rows, self.key, self.ts, self.event, self.n, self.seconds, self.mode)
        last = marked.groupBy(F.col(self.key).alias("_k")).agg(
            F.max("rn").alias("_total"), F.coalesce(F.max(F.when(F.col("fired"), F.col("rn"))), F.lit(0)).alias("_last"))
        # without reset the hits before a fire still count for the next
        open_from = F.lit(0) if self.mode == "windowed" else F.col("_last")
        still = marked.join(broadcast_if_bounded(last), F.col(self.key) == F.col("_k")).where(
            (F.col("rn") > open_from) & (F.col("rn") > F.col("_total") - F.col(self.n) + 1))
        if watermark is not None and self.mode != "cumulative":
            reach = F.unix_micros(F.col(self.ts)) + F.col(self.seconds).cast("long") * 1_000_000
            still = still.where(reach > F.unix_micros(F.lit(watermark)))
        still.select(*hits.columns).write.mode("overwrite").parquet(self._version(batch_id))
        self._prune(spark, batch_id - 2)
        return marked.where("fired and not _carried").select(*hits.columns)

    def _prune(self, spark: SparkSession, version: int) -> None:
        """Remove a version that no replay can ask for: only the last batch may be replayed."""
        if version >= 0:
            path = spark._jvm.org.apache.hadoop.fs.Path(self._version(version))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stateful_fires(
    hits: DataFrame, key: str, ts: str, event: str, n: str = "n", seconds: str = "seconds",
    mode: str = "cumulative",
) -> DataFrame:
    """Streaming fires with the open hits of each key in the state store.

    ``cumulative`` keeps a count; ``windowed_reset`` keeps the times of at most n hits.
    """
    if mode not in ("cumulative", "windowed_reset"):
        raise ValueError(f"no streaming counter for mode {mode!r}")
    schema: StructType = hits.schema

    def count(keys, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values([ts, event], ignore_index=True)
        open_times = list(state.get[0]) if state.exists else []
        fired = []
        for at, needed, limit in zip(rows[ts], rows[n], rows[seconds]):
            if pd.isna(needed) or needed < 1:  # such a counter never fires, and keeps nothing
                fired.append(False)
                continue
            micros = at.value // 1000
            if mode == "windowed_reset":
                open_times = [t for t in open_times if micros - t <= limit * 1_000_000]
            open_times.append(micros)
            hit = len(open_times) >= needed
            if hit:
                open_times = []
            fired.append(hit)
        state.update((open_times,))
        yield rows[fired]

    return hits.groupBy(key).applyInPandasWithState(
        count, schema, "open_times array<long>", "append", GroupStateTimeout.NoTimeout)
