"""Streaming stages: raw logs -> general logs and events -> composite events -> alarms, and flows.

Each stage is one query with its own checkpoint. Batches are written to folders named after the
batch, so a replay overwrites what it wrote before: deliveries count once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from secflow.operators import alarms, assets, events, normalize, parse
from secflow.operators.correlate import CompositeRules, Context
from secflow.sources import readers, sinks
from secflow.sources import rules as rule_source
from secflow.streaming.correlation import CompositeCounter
from secflow.streaming.counters import BatchCounter
from secflow.streaming.state import EventTimeBuffer, Outputs, StateTables

# Batch intervals and the age at which rules are read again.
LOG_INTERVAL = "1 second"
FLOW_INTERVAL = "5 seconds"
RULE_REFRESH_SECONDS = 300


@dataclass
class RuleCache:
    """Latest complete rule snapshot, looked up again after the refresh interval."""

    folder: str
    refresh_seconds: float = RULE_REFRESH_SECONDS
    _version: int | None = None
    _read_at: float = field(default=float("-inf"))

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return rule_source.operator_types(rule_source.read_snapshot(spark, self.folder, name, self.newest(spark)))

    def newest(self, spark: SparkSession) -> int:
        """The version that a table read now would have."""
        if time.monotonic() - self._read_at >= self.refresh_seconds:
            self._version = rule_source.latest_version(spark, self.folder)
            self._read_at = time.monotonic()
        return self._version

    def at(self, spark: SparkSession, batch_id: int) -> RuleCache:
        """The rules for a batch: here whatever is newest."""
        return self


class RuleLedger:
    """Rules pinned to batches: the version a batch first read is noted before the batch works.

    A batch that is replayed, also by a new process, reads its noted version again; other batches take
    the newest complete one within the cache's refresh interval.
    """

    def __init__(self, cache: RuleCache, folder: str):
        self.cache, self.notes = cache, StateTables(folder)

    def at(self, spark: SparkSession, batch_id: int) -> RuleCache:
        if not self.notes.has("rules", spark, batch_id):
            noted = spark.createDataFrame([(self.cache.newest(spark),)], "rules long").coalesce(1)
            self.notes.write("rules", noted, batch_id)
            self.notes.prune(spark, batch_id)
        version = self.notes.before(spark, "rules", batch_id + 1, "rules long").first()[0]
        return RuleCache(self.cache.folder, float("inf"), version, time.monotonic())


def composite_rules(tables: RuleCache, spark: SparkSession) -> CompositeRules:
    names = ("me_define", "me_sub", "me_detail", "me_leak", "me_flow", "me_asset", "me_intel")
    return CompositeRules(*[tables.table(spark, n) for n in names])


def in_turn(order: EventTimeBuffer | None, rows: DataFrame, batch_id: int) -> DataFrame:
    """Rows to count: all of the batch, or those whose turn it is by event time."""
    return rows if order is None else order.release(rows, batch_id)[0]


def start(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = LOG_INTERVAL
) -> StreamingQuery:
    """Run a stage every ``interval``, or once over all available input when it is None."""
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def log_stage(
    out: str, rules: RuleCache | RuleLedger, identity: str | None = None, with_log: bool = False
) -> Callable[[DataFrame, int], None]:
    """Raw lines -> raw logs with match flag, general logs, and built-in and user events.

    ``with_log`` adds each event's log, which correlation reads.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = rules.at(spark, batch_id)
        lines = parse.raw_parse(batch, identity=None if identity is None else F.col(identity))
        matched = normalize.match_rules(lines, tables.table(spark, "log_rule")).persist(StorageLevel.MEMORY_AND_DISK)
        general = normalize.general_from_matches(matched)
        sinks.write_batch(normalize.flag_matches(matched).drop("hit"), f"{out}/raw_log", batch_id)
        sinks.write_batch(general, f"{out}/general_log", batch_id)
        builtin = events.builtin_events(general, tables.table(spark, "event_def"), with_log)
        user = events.user_events(
            general, tables.table(spark, "user_event_def"), tables.table(spark, "user_event_field"), with_log=with_log)
        sinks.write_batch(events.all_events(builtin, user), f"{out}/event", batch_id)
        Outputs(out).commit(spark, batch_id)
        matched.unpersist()

    return process


def user_log_stage(
    out: str, rules: RuleCache | RuleLedger, identity: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Raw lines -> general logs by the users' own rules, which hold for every device."""

    def process(batch: DataFrame, batch_id: int) -> None:
        tables = rules.at(batch.sparkSession, batch_id)
        lines = parse.raw_parse(batch, identity=None if identity is None else F.col(identity))
        general = normalize.normalize(lines, tables.table(batch.sparkSession, "user_log_rule"), device_scoped=False)
        sinks.write_batch(sinks.general_log_docs(general, user=True), f"{out}/user_log", batch_id)

    return process


def correlation_stage(
    out: str, rules: RuleCache | RuleLedger, context: Callable[[SparkSession], Context], state: str, cve: str = "infoid",
    order: EventTimeBuffer | None = None,
) -> Callable[[DataFrame, int], None]:
    """Events with their log -> composite events and the links to their members.

    ``context`` reads the lookup tables anew for each batch; ``cve`` names the events' vulnerability column.
    """
    counter = CompositeCounter(state, cve)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = rules.at(spark, batch_id)
        made, members = counter.composites(
            in_turn(order, batch, batch_id), composite_rules(tables, spark), context(spark), batch_id)
        Outputs(out).publish({"composite_member": members, "composite": made}, batch_id)

    return process


def alarm_stage(
    out: str, rules: RuleCache | RuleLedger, state: str, kind: alarms.AlarmKind = alarms.SINGLE, mode: str = "cumulative",
    order: EventTimeBuffer | None = None,
) -> Callable[[DataFrame, int], None]:
    """Events (or composite events) -> alarms.

    With ``order`` they count in event time: late ones stay in the tables of earlier stages, and counters
    whose hits have all passed out of their limit are dropped.
    """
    counter = BatchCounter(state, "policy_id", "ts", "event_id", mode=mode)
    detail = "policy_event" if kind is alarms.SINGLE else "policy_composite"
    shape = alarms.from_events if kind is alarms.SINGLE else alarms.from_composites

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = rules.at(spark, batch_id)
        hits = alarms.policy_hits(
            in_turn(order, shape(batch), batch_id), tables.table(spark, "policy_whole"), tables.table(spark, detail), kind)
        mark = order.watermark(spark, batch_id + 1) if order is not None else None
        fires = counter.fires(hits, batch_id, mark)
        sinks.write_batch(alarms.alarm_rows(fires, kind), f"{out}/alarm", batch_id)

    return process


def flow_stage(out: str, identity: str | None = None) -> Callable[[DataFrame, int], None]:
    """JSON arrays of flows -> one map per flow. ``identity`` names the column that tells equal messages apart."""

    def process(batch: DataFrame, batch_id: int) -> None:
        named = None if identity is None else F.col(identity)
        sinks.write_batch(parse.flow_json_explode(batch, identity=named), f"{out}/netflow", batch_id)

    return process


def app_flow_stage(out: str, identity: str | None = None) -> Callable[[DataFrame, int], None]:
    """Application-flow lines -> one map per line. ``identity`` names the column that tells equal lines apart."""

    def process(batch: DataFrame, batch_id: int) -> None:
        named = None if identity is None else F.col(identity)
        sinks.write_batch(parse.appflow_line_parse(batch, identity=named), f"{out}/app_flow", batch_id)

    return process


def asset_stage(
    out: str, registered: Callable[[SparkSession], DataFrame], ranges: list[str]
) -> Callable[[DataFrame, int], None]:
    """Flows -> assets seen for the first time, inserted if absent.

    A batch adds the addresses that neither the register nor a committed earlier batch holds; its replay
    sees the same earlier batches and writes the same rows again.
    """
    outputs = Outputs(out)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = outputs.read(spark, "asset", "ip string", before=batch_id)
        outputs.publish({"asset": assets.discover_assets(batch, registered(spark), ranges, known)}, batch_id)

    return process


def committed(
    process: Callable[[DataFrame, int], None], out: str, name: str, schema: StructType | str
) -> Callable[[DataFrame, int], None]:
    """A stage fed by the commit records of the stage before it: ``process`` gets the rows of each record's batch.

    Several stages may read one output, each by a stream of its own over the records.
    """

    def over_records(records: DataFrame, batch_id: int) -> None:
        # one number per batch of the stage before
        batches = sorted(r.done for r in records.select("done").distinct().collect())
        paths = [f"{out}/{name}/batch={b}" for b in batches]
        spark = records.sparkSession
        process(spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema), batch_id)

    return over_records


def commit_stream(spark: SparkSession, out: str, records_per_batch: int = 1) -> DataFrame:
    """Commit records of a stage as a stream."""
    return readers.file_stream(spark, f"{out}/commits/*", "done long", files_per_batch=records_per_batch)


def general_log_stream(lines: DataFrame, rules: DataFrame, identity: str | None = None) -> DataFrame:
    """Stateless streaming form of parse and normalise, for rules fixed at the start."""
    parsed = parse.raw_parse(lines, identity=None if identity is None else F.col(identity))
    return normalize.normalize(parsed, rules)
