"""Streams over time-ordered files give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from secflow.operators import alarms, events, normalize, parse
from secflow.operators.threshold import threshold_fire
from secflow.plans.tables import frame
from secflow.sources import readers, rules
from secflow.streaming import jobs
from secflow.streaming.counters import BatchCounter, stateful_fires

SF = "/root/testdata/sf0.001"


def _files(df, order, path, parts=4):
    """Time-ordered files, one micro-batch each."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(path)


def _run(stream, process, path):
    query = jobs.start(stream, process, path, None)
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture(scope="module")
def hits(spark):
    general = normalize.normalize(frame(spark, SF, "raw_log"), frame(spark, SF, "log_rule"))
    events_ = events.builtin_events(general, frame(spark, SF, "event_def"))
    return alarms.policy_hits(
        alarms.from_events(events_), frame(spark, SF, "policy_whole"), frame(spark, SF, "policy_event"))


@pytest.mark.parametrize("mode", ["cumulative", "windowed_reset"])
def test_stateful_counter_equals_batch(spark, hits, tmp_path, mode):
    _files(hits, "ts", str(tmp_path / "in"))
    stream = readers.file_stream(spark, str(tmp_path / "in"), hits.schema, files_per_batch=1)
    fires = stateful_fires(stream, "policy_id", "ts", "event_id", mode=mode)
    query = (
        fires.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    got = {(r.policy_id, r.event_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {(r.policy_id, r.event_id) for r in threshold_fire(hits, "policy_id", "ts", "event_id", mode=mode).collect()}
    assert got == batch and got


def test_logs_to_alarms(spark, tmp_path):
    """Raw lines -> events -> alarms in two chained stages equals one batch plan."""
    folder = str(tmp_path / "rules")
    names = ["log_rule", "event_def", "user_event_def", "user_event_field", "policy_whole", "policy_event"]
    rules.write_snapshot({n: frame(spark, SF, n) for n in names}, folder, 1)
    cache = jobs.RuleCache(folder)
    lines = frame(spark, SF, "raw_line").withColumn("n", F.monotonically_increasing_id())
    _files(lines, "n", str(tmp_path / "lines"), 3)
    out = str(tmp_path / "out")
    stream = readers.file_stream(spark, str(tmp_path / "lines"), lines.schema, files_per_batch=1)
    _run(stream, jobs.log_stage(out, cache), str(tmp_path / "cp1"))

    parsed = parse.raw_parse(lines)
    general = normalize.normalize(parsed, frame(spark, SF, "log_rule"))
    stored = spark.read.parquet(f"{out}/raw_log")
    assert stored.count() == parsed.count() and stored.where("is_match = 0").count() == general.count()
    assert spark.read.parquet(f"{out}/general_log").count() == general.count()
    builtin = events.builtin_events(general, frame(spark, SF, "event_def"))
    user = events.user_events(general, frame(spark, SF, "user_event_def"), frame(spark, SF, "user_event_field"))
    expected = {r.event_result_id for r in events.all_events(builtin, user).select("event_result_id").collect()}
    made = spark.read.parquet(f"{out}/event")
    assert {r.event_result_id for r in made.select("event_result_id").collect()} == expected

    event_files = str(tmp_path / "event_files")
    _files(made.drop("batch"), "open_time", event_files)
    for mode in ("cumulative", "windowed_reset"):
        target = str(tmp_path / mode)
        stream = readers.file_stream(spark, event_files, made.drop("batch").schema, files_per_batch=1)
        stage = jobs.alarm_stage(target, cache, f"{target}/state", mode=mode)
        _run(stream, stage, f"{target}/cp")
        batch = alarms.alarms(
            alarms.from_events(made), frame(spark, SF, "policy_whole"), frame(spark, SF, "policy_event"), mode=mode)
        got = {r.record_id for r in spark.read.parquet(f"{target}/alarm").collect()}
        assert got == {r.record_id for r in batch.collect()} and got


def test_replayed_batch_repeats_its_fires(spark, hits, tmp_path):
    first, second = hits.where("event_id < '8'"), hits.where("event_id >= '8'")
    counter = BatchCounter(str(tmp_path / "state"), "policy_id", "ts", "event_id")
    counter.fires(first, 0).count()
    fires = [sorted(r.event_id for r in counter.fires(second, 1).collect()) for _ in range(2)]
    assert fires[0] == fires[1] and fires[0]
    # open hits stay below the policy's count
    open_hits = spark.read.parquet(str(tmp_path / "state" / "version=1")).groupBy("policy_id", "n").count().collect()
    assert all(r["count"] < r.n for r in open_hits)


def test_rules_refresh_between_batches(spark, tmp_path):
    folder = str(tmp_path / "rules")
    one = spark.createDataFrame([("a",)], "id string")
    rules.write_snapshot({"r": one}, folder, 1)
    fresh, stale = jobs.RuleCache(folder, 0), jobs.RuleCache(folder, 3600)
    assert fresh.table(spark, "r").count() == stale.table(spark, "r").count() == 1
    rules.write_snapshot({"r": one.union(one)}, folder, 2)
    assert fresh.table(spark, "r").count() == 2 and stale.table(spark, "r").count() == 1


def test_flow_stages(spark, tmp_path):
    for name, stage, target in (
            ("flow_message", jobs.flow_stage, "netflow"), ("app_flow_line", jobs.app_flow_stage, "app_flow")):
        source, out = str(tmp_path / f"{name}_in"), str(tmp_path / f"{name}_out")
        lines = frame(spark, SF, name)
        lines.repartition(3).write.parquet(source)
        stream = readers.file_stream(spark, source, lines.schema, files_per_batch=2)
        _run(stream, stage(out), str(tmp_path / f"{name}_cp"))
        batch = parse.flow_json_explode(lines) if target == "netflow" else parse.appflow_line_parse(lines)
        assert spark.read.parquet(f"{out}/{target}").count() == batch.count() > 0


def test_stateless_general_log_stream(spark, tmp_path):
    lines = frame(spark, SF, "raw_line")
    lines.write.parquet(str(tmp_path / "in"))
    stream = jobs.general_log_stream(
        readers.file_stream(spark, str(tmp_path / "in"), lines.schema), frame(spark, SF, "log_rule"))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    expected = normalize.normalize(parse.raw_parse(lines), frame(spark, SF, "log_rule")).count()
    assert spark.read.parquet(str(tmp_path / "out")).count() == expected > 0


@pytest.mark.parametrize("mode", ["cumulative", "windowed", "windowed_reset"])
def test_counter_over_batches_equals_one_plan(spark, tmp_path, mode):
    """Each micro-batch, and its replay, fires what one plan over all hits fires; old versions go."""
    rows = [("k", f"e{i}", i, 3, 60) for i in range(8)] + [("z", f"z{i}", i, 0, 60) for i in range(4)]
    hits = spark.createDataFrame(rows, "key string, event string, second int, n int, seconds int").selectExpr(
        "key", "timestamp_seconds(second) as ts", "event", "n", "seconds")
    counter = BatchCounter(str(tmp_path / "state"), "key", "ts", "event", mode=mode)
    fired = []
    for batch, (low, high) in enumerate([(0, 3), (3, 4), (4, 8)]):
        part = hits.where(F.unix_seconds("ts").between(low, high - 1))
        once = sorted(r.event for r in counter.fires(part, batch).collect())
        assert sorted(r.event for r in counter.fires(part, batch).collect()) == once
        fired += once
    assert sorted(fired) == sorted(r.event for r in threshold_fire(hits, "key", "ts", "event", mode=mode).collect())
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["version=1", "version=2"]
