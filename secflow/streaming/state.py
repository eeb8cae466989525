"""State between micro-batches: small tables as Parquet, one version per batch, and the event-time buffer.

Batch i reads version i - 1 and writes version i. A replayed batch does the same again, so nothing counts
twice. Only the last batch can be replayed, so older versions go.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from secflow.plans.physical import checkpointed


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def batches_in(spark: SparkSession, folder: str) -> list[int]:
    """Batches that have a folder ``batch=i`` here."""
    place, files = _place(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


class StateTables:
    """Named tables in ``folder/version=i/name``."""

    def __init__(self, folder: str):
        self.folder = folder

    def path(self, name: str, batch_id: int) -> str:
        return f"{self.folder}/version={batch_id}/{name}"

    def before(self, spark: SparkSession, name: str, batch_id: int, schema: StructType | str) -> DataFrame:
        """The table as the batch before ``batch_id`` left it; empty before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path(name, batch_id - 1))

    def has(self, name: str, spark: SparkSession, batch_id: int) -> bool:
        """Whether the batch has completed the table; Spark marks a finished folder."""
        place, files = _place(spark, f"{self.path(name, batch_id)}/_SUCCESS")
        return files.exists(place)

    def write(self, name: str, table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(self.path(name, batch_id))

    def prune(self, spark: SparkSession, batch_id: int) -> None:
        """After ``batch_id``: its own version and the one before stay."""
        if batch_id >= 2:
            remove(spark, f"{self.folder}/version={batch_id - 2}")


class Outputs:
    """Several outputs of a stage that become visible together.

    A batch writes each output to ``folder/name/batch=i`` and then one commit record. Readers see the
    batches that have a record, so a crash between two outputs shows nothing of its batch, and the replay
    overwrites what was written.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def publish(self, outputs: dict[str, DataFrame], batch_id: int) -> None:
        for name, rows in outputs.items():
            rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch_id}")
        self.commit(next(iter(outputs.values())).sparkSession, batch_id)

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        record = spark.createDataFrame([(batch_id,)], "done long").coalesce(1)
        record.write.mode("overwrite").parquet(f"{self.folder}/commits/batch={batch_id}")

    def batches(self, spark: SparkSession) -> list[int]:
        """Committed batches in order."""
        found = []
        for batch in batches_in(spark, f"{self.folder}/commits"):
            place, files = _place(spark, f"{self.folder}/commits/batch={batch}/_SUCCESS")
            if files.exists(place):
                found.append(batch)
        return found

    def read(
        self, spark: SparkSession, name: str, schema: StructType | str, first: int = 0, before: int | None = None
    ) -> DataFrame:
        """Rows of committed batches, from ``first`` up to but not ``before`` another; empty if there are none."""
        wanted = [b for b in self.batches(spark) if b >= first and (before is None or b < before)]
        if not wanted:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.folder}/{name}/batch={b}" for b in wanted])


class EventTimeBuffer:
    """Rows in event-time order over micro-batches.

    The watermark is the largest time seen, less ``delay_seconds``. Rows above it are held; a batch
    releases the rows that the watermark has passed since the last one, so whatever is counted over the
    released rows is counted in order of event time. A row at or below the watermark of an earlier batch
    is late: its neighbours have been counted, so it is returned apart and not counted. Rows without a
    time are late too. What is held is bounded by the rows of the delay, not by the stream.
    """

    def __init__(self, state_path: str, ts: str, delay_seconds: int):
        self.tables, self.ts, self.delay = StateTables(state_path), ts, delay_seconds

    def watermark(self, spark: SparkSession, batch_id: int) -> datetime | None:
        """The watermark that the batch before ``batch_id`` left."""
        row = self.tables.before(spark, "mark", batch_id, "mark timestamp").first()
        return row.mark if row else None

    def release(self, rows: DataFrame, batch_id: int, final: bool = False) -> tuple[DataFrame, DataFrame]:
        """The rows whose turn it is, and the late rows of this batch. ``final`` releases all that is held."""
        spark, at = rows.sparkSession, F.col(self.ts)
        schema = StructType([field for field in rows.schema])
        rows = checkpointed(rows)  # read three times; a retried read must not see other rows
        mark = self.watermark(spark, batch_id)
        seen = rows.agg(F.max(at)).first()[0]
        reached = mark
        if seen is not None:
            moved = spark.range(1).select((F.lit(seen) - F.make_dt_interval(secs=F.lit(self.delay))).alias("m")).first().m
            reached = moved if mark is None else max(mark, moved)
        in_time = at.isNotNull() if mark is None else at > F.lit(mark)
        late = rows.where(~F.coalesce(in_time, F.lit(False)))
        waiting = self.tables.before(spark, "held", batch_id, schema).unionByName(rows.where(in_time))
        if final:
            due = F.lit(True)
        else:
            due = F.lit(False) if reached is None else at <= F.lit(reached)
        self.tables.write("held", waiting.where(~due), batch_id)
        self.tables.write("mark", spark.createDataFrame([(reached,)], "mark timestamp").coalesce(1), batch_id)
        self.tables.prune(spark, batch_id)
        return waiting.where(due), late
