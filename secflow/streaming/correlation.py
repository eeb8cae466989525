"""Correlation as a stream: event hits to composite events and their members.

The state of a definition is small: how many hits it has had, its last fire, the latest hits with a
vulnerability, and of each counter the hits since that fire which can still count, fewer than the count
asked for. A micro-batch numbers its hits after those, puts the open hits in front of its own, and runs
the batch chain from the last fire on; so hot definitions are split over tasks as in batch.

The events behind a composite may lie in many earlier batches. Each batch appends its hits that no
composite has claimed to a folder of its own; when a definition fires, the folders since its last fire
are read for that definition. Nothing is rewritten while a definition waits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.functions.text import stable_id
from secflow.operators import correlate
from secflow.operators.correlate import Carried, CompositeRules, Context
from secflow.plans.physical import broadcast_if_bounded, checkpointed
from secflow.streaming.state import StateTables, batches_in, remove

_SINCE = "def_id string, since long"
_PENDING = "def_id string, fire_seq long, event_result_id string, batch long"


class CompositeCounter:
    """Composite events for ``foreachBatch``; batches come in order, the last one may be replayed."""

    def __init__(self, state_path: str, cve: str = "cve", strict: bool = True):
        self.tables, self.pending = StateTables(state_path), f"{state_path}/pending"
        self.cve, self.strict = cve, strict

    def composites(
        self, events: DataFrame, rules: CompositeRules, context: Context, batch_id: int
    ) -> tuple[DataFrame, DataFrame]:
        """Composite records that fire in this batch, and the links to their events."""
        spark = events.sparkSession
        carried = Carried(
            self.tables.before(spark, "defs", batch_id, correlate.CARRIED_DEFS),
            self.tables.before(spark, "open", batch_id, correlate.OPEN_HITS))
        since = self.tables.before(spark, "since", batch_id, _SINCE)

        hits = correlate.definition_hits(events, rules, context, self.strict, self.cve, carried)
        counted = correlate.definition_counts(hits, carried)
        floors = correlate.counted_floors(hits, counted, rules, context)
        chained = checkpointed(correlate.composite_events(floors, carried))

        after = correlate.carry_on(carried, hits, counted, chained)
        self.tables.write("defs", after.defs, batch_id)
        self.tables.write("open", after.open_hits, batch_id)
        after = self.tables.before(spark, "defs", batch_id + 1, correlate.CARRIED_DEFS)
        members = self._members(spark, chained, carried.defs, after, since, batch_id)
        self._write_since(chained, since, batch_id)
        self._prune(spark, batch_id)
        return correlate.composite_rows(chained), members

    def _members(
        self, spark: SparkSession, chained: DataFrame, before: DataFrame, after: DataFrame, since: DataFrame, batch_id: int
    ) -> DataFrame:
        fires = broadcast_if_bounded(after.select(F.col("def_id").alias("_d"), F.col("fires").alias("_fires")))
        hits = chained.select("def_id", "fire_seq", "event_result_id").join(fires, F.col("def_id") == F.col("_d"))
        waiting = hits.where("fire_seq >= _fires").select("def_id", "fire_seq", "event_result_id")
        waiting.write.mode("overwrite").parquet(f"{self.pending}/batch={batch_id}")
        claimed = hits.where("fire_seq < _fires").select("def_id", "fire_seq", "event_result_id")

        # definitions that fired, with the number of their first composite here and the folders it reaches back to
        started = chained.where("fired").groupBy("def_id").agg(F.min("fire_seq").alias("_seq")).join(since, "def_id")
        reach = started.agg(F.min("since")).first()[0]
        if reach is not None and reach < batch_id:
            earlier = spark.read.schema(_PENDING).option("basePath", self.pending).parquet(self.pending).where(
                F.col("batch").between(reach, batch_id - 1))
            fired = broadcast_if_bounded(started.select(F.col("def_id").alias("_d"), "_seq"))
            claimed = claimed.unionByName(earlier.join(
                fired, (F.col("def_id") == F.col("_d")) & (F.col("fire_seq") == F.col("_seq"))).select(*claimed.columns))
        composite = stable_id("composite", F.col("def_id"), F.col("fire_seq"))
        return claimed.select(
            stable_id("member", composite, F.col("event_result_id")).alias("record_id"),
            "event_result_id", composite.alias("composite_id"))

    def _write_since(self, chained: DataFrame, since: DataFrame, batch_id: int) -> None:
        """The first batch whose hits a definition's next composite claims."""
        now = chained.groupBy(F.col("def_id").alias("_d")).agg(F.max("fired").alias("_fired"))
        merged = since.join(now, F.col("def_id") == F.col("_d"), "full")
        here = F.lit(batch_id).cast("long")
        self.tables.write("since", merged.select(
            F.coalesce("def_id", "_d").alias("def_id"),
            F.when(F.col("_fired"), here).otherwise(F.coalesce("since", here)).alias("since")), batch_id)

    def _prune(self, spark: SparkSession, batch_id: int) -> None:
        """Remove pending folders that neither a later batch nor a replay of this one reads."""
        needed = self.tables.before(spark, "since", batch_id, _SINCE).agg(F.min("since")).first()[0]
        for batch in batches_in(spark, self.pending):
            if needed is not None and batch < needed:
                remove(spark, f"{self.pending}/batch={batch}")
        self.tables.prune(spark, batch_id)
