"""Correlation, event time and rule synchronisation over micro-batches give what one batch plan gives."""

import os

import pytest
from pyspark.sql import functions as F

from secflow.operators import alarms, assets, correlate, events, normalize, parse
from secflow.operators.threshold import threshold_fire
from secflow.plans.tables import MONITORED_RANGES, composite_rules, context, corr_events, frame
from secflow.sources import readers, rules, sinks
from secflow.streaming import jobs
from secflow.streaming.correlation import CompositeCounter
from secflow.streaming.counters import BatchCounter
from secflow.streaming.state import EventTimeBuffer, Outputs, StateTables

SF = "/root/testdata/sf0.001"


def _slices(df, ts, parts):
    """Rows in time order, in slices that no instant crosses."""
    times = [r[0] for r in df.select(ts).distinct().orderBy(ts).collect()]
    size = -(-len(times) // parts)
    edges = [times[k] for k in range(0, len(times), size)] + [None]
    for low, high in zip(edges, edges[1:]):
        part = df.where(F.col(ts) >= F.lit(low))
        yield part if high is None else part.where(F.col(ts) < F.lit(high))


def _keys(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


# --- composite events -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def whole(spark):
    chained = correlate.composite_events(correlate.definition_floors(
        corr_events(spark, SF), composite_rules(spark, SF), context(spark, SF)))
    rows = correlate.composite_rows(chained)
    return (
        _keys(rows, "record_id", "me_def_id", "storage_time"),
        _keys(correlate.composite_members(chained), "record_id", "event_result_id", "composite_id"))


def test_stream_equals_batch_for_every_definition(spark, whole, tmp_path):
    """Three micro-batches, one replayed by a new counter, fire the same composites with the same members."""
    composites, members = [], []
    for batch, part in enumerate(_slices(corr_events(spark, SF), "open_time", 3)):
        for attempt in range(2 if batch == 1 else 1):
            counter = CompositeCounter(str(tmp_path / "state"))
            made, links = counter.composites(part, composite_rules(spark, SF), context(spark, SF), batch)
            found = _keys(made, "record_id", "me_def_id", "storage_time"), _keys(
                links, "record_id", "event_result_id", "composite_id")
            assert attempt == 0 or found == again
            again = found
        composites += found[0]
        members += found[1]
    assert sorted(composites) == whole[0] and sorted(members) == whole[1]
    assert {"d1", "d3", "d4", "d6", "d9"} <= {c[1] for c in composites}
    # definitions that fired across a border: the state was needed
    assert spark.read.parquet(str(tmp_path / "state" / "version=2" / "defs")).where("last_fire > 0").count() >= 5
    # open hits stay below the counts, versions and pending folders go
    open_hits = spark.read.parquet(str(tmp_path / "state" / "version=2" / "open")).groupBy("detail_id", "times").count()
    assert all(r["count"] < r.times for r in open_hits.collect())
    assert sorted(p for p in os.listdir(tmp_path / "state") if p.startswith("version")) == ["version=1", "version=2"]


def test_members_from_many_batches(spark, tmp_path):
    """A definition that fires once, after batches without events, claims its hits of all of them."""
    rows = [(str(k), f"2024-01-01 00:00:{k:02d}") for k in range(8)]
    schema = corr_events(spark, SF).schema
    template = corr_events(spark, SF).where("event_rule_id = 'er_view'").limit(1)
    detail = frame(spark, SF, "me_detail").where("record_id = 'm3'").withColumn("times", F.lit(7))
    given = composite_rules(spark, SF)
    given = correlate.CompositeRules(
        given.defs, given.subs.where("record_id = 's3'"), detail, given.leaks, given.flows, given.assets, given.intels)
    made = spark.createDataFrame(rows, "id string, at string").crossJoin(F.broadcast(template.drop("event_result_id", "open_time")))
    all_events = made.withColumn("event_result_id", F.col("id")).withColumn(
        "open_time", F.to_timestamp("at")).select(*[f.name for f in schema])
    counter = CompositeCounter(str(tmp_path / "state"))
    links, fired = [], []
    for batch, (low, high) in enumerate([(0, 3), (3, 3), (3, 8)]):
        part = all_events.where(F.col("event_result_id").cast("int").between(low, high - 1))
        composites, members = counter.composites(part, given, context(spark, SF), batch)
        fired.append(composites.count())
        links += [r.event_result_id for r in members.collect()]
    assert fired == [0, 0, 1] and sorted(links) == [str(k) for k in range(7)]


def test_stages_as_streams(spark, whole, tmp_path):
    """Event files -> composite stage -> composite alarms, as streaming queries."""
    source, out = str(tmp_path / "events"), str(tmp_path / "out")
    for part in _slices(corr_events(spark, SF), "open_time", 2):
        part.coalesce(1).write.mode("append").parquet(source)
    folder = str(tmp_path / "rules")
    names = ["me_define", "me_sub", "me_detail", "me_leak", "me_flow", "me_asset", "me_intel", "policy_whole", "policy_composite"]
    rules.write_snapshot({n: frame(spark, SF, n) for n in names}, folder, 1)
    cache = jobs.RuleCache(folder)
    stage = jobs.correlation_stage(out, cache, lambda s: context(s, SF), f"{out}/state", cve="cve")
    stream = readers.file_stream(spark, source, corr_events(spark, SF).schema, files_per_batch=1)
    query = jobs.start(stream, stage, f"{out}/cp", None)
    query.awaitTermination()
    made = spark.read.parquet(f"{out}/composite")
    assert made.select("batch").distinct().count() >= 2
    assert _keys(made, "record_id", "me_def_id", "storage_time") == whole[0]
    assert _keys(spark.read.parquet(f"{out}/composite_member"), "record_id", "event_result_id", "composite_id") == whole[1]

    policies = frame(spark, SF, "policy_whole"), frame(spark, SF, "policy_composite")
    expected = alarms.alarms(alarms.from_composites(made), *policies, kind=alarms.COMPOSITE)
    alarm = jobs.alarm_stage(out, cache, f"{out}/alarm_state", alarms.COMPOSITE)
    for batch, part in enumerate(_slices(made.drop("batch"), "storage_time", 3)):
        alarm(part, batch)
    assert _keys(spark.read.parquet(f"{out}/alarm"), "record_id") == _keys(expected, "record_id") != []


# --- event time -----------------------------------------------------------------------------------


def _hit_rows(spark, seconds):
    return spark.createDataFrame(
        [("k", f"e{i:02d}", s, 3, 40) for i, s in enumerate(seconds)],
        "key string, event string, second int, n int, seconds int").selectExpr(
        "key", "timestamp_seconds(second) AS ts", "event", "n", "seconds")


@pytest.mark.parametrize("mode", ["cumulative", "windowed", "windowed_reset"])
def test_out_of_order_equals_batch(spark, tmp_path, mode):
    """Rows up to the delay late, over four batches with replays, count as if they had come in order."""
    seconds = [10, 35, 20, 30, 65, 50, 55, 90, 61, 80, 70, 120, 110, 100, 300]
    hits = _hit_rows(spark, seconds)
    expected = _keys(threshold_fire(hits, "key", "ts", "event", mode=mode), "event")
    fired = []
    for batch, (low, high) in enumerate([(0, 4), (4, 8), (8, 12), (12, 15)]):
        part = hits.where(F.substring("event", 2, 2).cast("int").between(low, high - 1))
        for _ in range(2):
            buffer = EventTimeBuffer(str(tmp_path / "time"), "ts", 30)
            counter = BatchCounter(str(tmp_path / "count"), "key", "ts", "event", mode=mode)
            due, late = buffer.release(part, batch, final=batch == 3)
            assert late.count() == 0
            found = _keys(counter.fires(due, batch, buffer.watermark(spark, batch + 1)), "event")
        fired += found
    assert sorted(fired) == expected and expected


def test_late_and_timeless_rows_stay_out(spark, tmp_path):
    buffer = EventTimeBuffer(str(tmp_path / "time"), "ts", 10)
    first = _hit_rows(spark, [5, 100, 95])
    due, late = buffer.release(first, 0)
    assert _keys(due, "event") == [("e00",)] and late.count() == 0
    second = _hit_rows(spark, [90, 91, 200]).withColumn("event", F.concat("event", F.lit("b"))).unionByName(
        _hit_rows(spark, [1]).withColumn("ts", F.lit(None).cast("timestamp")).withColumn("event", F.lit("none")))
    due, late = buffer.release(second, 1)
    assert _keys(late, "event") == [("e00b",), ("none",)]
    assert _keys(due, "event") == [("e01",), ("e01b",), ("e02",)]
    due, late = buffer.release(second.where("false"), 2, final=True)
    assert _keys(due, "event") == [("e02b",)] and late.count() == 0


def test_idle_counters_leave_the_state(spark, tmp_path):
    buffer = EventTimeBuffer(str(tmp_path / "time"), "ts", 0)
    counter = BatchCounter(str(tmp_path / "count"), "key", "ts", "event", mode="windowed_reset")
    kept = []
    for batch, seconds in enumerate([[1, 2], [500]]):
        rows = _hit_rows(spark, seconds).withColumn("key", F.lit(f"key{batch}"))
        due, _ = buffer.release(rows, batch)
        counter.fires(due, batch, buffer.watermark(spark, batch + 1)).count()
        kept.append(_keys(spark.read.parquet(str(tmp_path / "count" / f"version={batch}")), "key"))
    assert kept == [[("key0",)] * 2, [("key1",)]]


def test_hot_key_is_spread(spark, tmp_path):
    """A policy that owns every hit: no task of the counter reads more than a share of them."""
    hits = spark.range(40_000).selectExpr(
        "'k' AS key", "timestamp_seconds(id) AS ts", "cast(id AS string) AS event", "3 AS n", "60 AS seconds")
    counter = BatchCounter(str(tmp_path / "count"), "key", "ts", "event", mode="windowed")
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are put together again
    spark.conf.set(small, "false")
    per_task = counter.fires(hits, 0).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset(small)
    assert sum(r["count"] for r in per_task) == 39_998
    assert len(per_task) >= 2 and max(r["count"] for r in per_task) < 30_000


# --- rules ----------------------------------------------------------------------------------------


def _store(spark, folder):
    """A rule store as Parquet tables under its own names, from the frames the operators read."""
    store_names = {v: k for k, v in rules.OPERATOR_NAMES.items()}
    extra = {"is_inner": F.lit(0), "is_use": F.lit(1), "status": F.lit(1)}
    made = {}
    for name, rule_set in rules.OPERATOR_TABLES.items():
        spec = rules.RULE_SETS[rule_set]
        if name == "monitored_ip":
            continue
        rows = frame(spark, SF, name)
        rows = rows.withColumnsRenamed({c: store_names[c] for c in rows.columns if c in store_names and c not in spec.columns})
        made[name] = rows.select(*[
            (F.col(c) if c in rows.columns else extra.get(c, F.lit(None).cast("string"))).alias(c) for c in spec.columns]), spec
    watched = F.expr("CASE eventid WHEN 'er_error' THEN 'ER-Error ' WHEN 'er_purchase' THEN 'er-buy' "
                     "ELSE replace(eventid, '_', '-') END")
    made["me_detail"] = made["me_detail"][0].withColumn("eventid", watched), made["me_detail"][1]
    builtin = frame(spark, SF, "event_def")
    defs = builtin.select(
        "event_rule_id", "event_rule_name", "event_rule_level", F.lit(1).alias("is_inner"), F.lit(1).alias("is_use"))
    fields = builtin.select(
        "event_rule_id", F.lit("eventname").alias("event_rule_field"), F.lit("1").alias("match_method"),
        F.col("begin_value").alias("filed_begin_value"))
    made["user_event_def"] = made["user_event_def"][0].unionByName(defs, allowMissingColumns=True), made["user_event_def"][1]
    made["user_event_field"] = (
        made["user_event_field"][0].unionByName(fields, allowMissingColumns=True), made["user_event_field"][1])
    device = F.trim("device_ip")
    regexes = frame(spark, SF, "log_rule").select(
        "log_rule_id", F.concat(F.lit("lib"), device).alias("log_rule_lib_id"), "log_regex",
        F.col("event_def_id").alias("eventdefid"), F.col("event_level").alias("eventlevel"),
        F.col("report_ne_type").alias("reportnetype"), F.col("event_id").alias("eventid"), F.lit("1").alias("is_inner"))
    own = made["user_log_rule"][0].withColumn("is_inner", F.lit("0"))
    made["user_log_rule"] = own.unionByName(regexes, allowMissingColumns=True), made["user_log_rule"][1]
    for rows, spec in made.values():
        rows.write.mode("overwrite").parquet(f"{folder}/{spec.table}")
    devices = frame(spark, SF, "log_rule").select(device.alias("device_ip")).distinct()
    asset = devices.select(F.hash("device_ip").alias("ne_id"), F.lit(1).alias("htypeid"), F.lit(2).alias("vendorid"),
                           F.col("device_ip").alias("model"))
    asset.write.mode("overwrite").parquet(f"{folder}/t_siem_moni_ne")
    devices.select(F.hash("device_ip").alias("ne_id"), "device_ip").write.mode("overwrite").parquet(f"{folder}/t_moni_device_ip")
    devices.select(
        F.concat(F.lit("lib"), "device_ip").alias("LOG_RULE_LIB_ID"), F.lit(1).alias("HTYEID"), F.lit(2).alias("VENDORID"),
        F.col("device_ip").alias("MODEL")).write.mode("overwrite").parquet(f"{folder}/t_siem_log_regex_lib")


@pytest.fixture(scope="module")
def snapshots(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rules")
    _store(spark, str(folder / "store"))
    rules.sync_rules(spark, str(folder / "snapshots"), 1, store=str(folder / "store"))
    return str(folder / "snapshots")


def test_all_rule_sets_arrive(spark, snapshots):
    cache = jobs.RuleCache(snapshots)
    names = [*rules.OPERATOR_TABLES, "log_rule", "event_def"]
    assert len(names) == 17
    for name in names:
        assert cache.table(spark, name).count() > 0, name
    # the joined sets, in the order of their ids, and texts back as numbers
    assert [r.rule_ord for r in cache.table(spark, "log_rule").orderBy("rule_ord").collect()] == list(
        range(1, frame(spark, SF, "log_rule").count() + 1))
    assert dict(cache.table(spark, "me_detail").dtypes)["times"] == "bigint"
    assert {r.event_rule_id for r in cache.table(spark, "event_def").collect()} == {
        r.event_rule_id for r in frame(spark, SF, "event_def").collect()}
    assert {r.event_rule_id for r in cache.table(spark, "user_event_def").collect()} == {
        r.event_rule_id for r in frame(spark, SF, "user_event_def").collect()}


def test_store_to_composite_alarms(spark, snapshots, tmp_path):
    """Rule store -> snapshot -> log stage -> correlation -> single and composite alarms, against the batch plan."""
    cache, out = jobs.RuleCache(snapshots), str(tmp_path)
    lines = frame(spark, SF, "raw_line")
    at = F.regexp_extract("value", r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)", 1)
    ledger = jobs.RuleLedger(cache, f"{out}/ledger")
    log = jobs.log_stage(out, ledger, with_log=True)
    correlation = jobs.correlation_stage(out, ledger, lambda s: context(s, SF), f"{out}/state")
    single = jobs.alarm_stage(out + "/single", cache, f"{out}/single_state")
    composite = jobs.alarm_stage(out + "/composite_alarm", cache, f"{out}/composite_state", alarms.COMPOSITE)
    for batch, part in enumerate(_slices(lines.withColumn("at", at), "at", 2)):
        log(part.select("value"), batch)
        made = spark.read.parquet(f"{out}/event/batch={batch}")
        correlation(made, batch)
        single(made, batch)
        composite(spark.read.parquet(f"{out}/composite/batch={batch}"), batch)

    f = lambda n: frame(spark, SF, n)
    general = normalize.normalize(parse.raw_parse(lines), f("log_rule"))
    everything = events.all_events(
        events.builtin_events(general, f("event_def"), True),
        events.user_events(general, f("user_event_def"), f("user_event_field"), with_log=True))
    stored = spark.read.parquet(f"{out}/event")
    assert _keys(stored, "event_result_id") == _keys(everything, "event_result_id")
    given = jobs.composite_rules(cache, spark)
    chained = correlate.composite_events(correlate.definition_floors(everything, given, context(spark, SF), cve="infoid"))
    rows = correlate.composite_rows(chained)
    assert _keys(spark.read.parquet(f"{out}/composite"), "record_id") == _keys(rows, "record_id")
    assert rows.select("me_def_id").distinct().count() >= 2
    for kind, name, shaped, detail in (
            (alarms.SINGLE, "single", alarms.from_events(everything), "policy_event"),
            (alarms.COMPOSITE, "composite_alarm", alarms.from_composites(rows), "policy_composite")):
        expected = alarms.alarms(shaped, f("policy_whole"), f(detail), kind)
        assert _keys(spark.read.parquet(f"{out}/{name}/alarm"), "record_id") == _keys(expected, "record_id") != []


def test_user_log_stage(spark, snapshots, tmp_path):
    lines = frame(spark, SF, "raw_line")
    stage = jobs.user_log_stage(str(tmp_path), jobs.RuleCache(snapshots))
    for batch, part in enumerate(lines.randomSplit([1.0, 1.0], 3)):
        stage(part, batch)
    expected = sinks.general_log_docs(normalize.normalize(
        parse.raw_parse(lines), frame(spark, SF, "user_log_rule"), device_scoped=False), user=True)
    made = spark.read.parquet(f"{tmp_path}/user_log")
    assert _keys(made, "row") == _keys(expected, "row") != []


def test_replayed_batch_reads_its_rules_again(spark, tmp_path):
    """Rules refreshed between a batch and its replay do not change it; the next batch reads the new ones."""
    folder, notes = str(tmp_path / "rules"), str(tmp_path / "notes")
    one = spark.createDataFrame([("a",)], "id string")
    rules.write_snapshot({"r": one}, folder, 1)
    count = lambda batch: jobs.RuleLedger(jobs.RuleCache(folder, 0), notes).at(spark, batch).table(spark, "r").count()
    assert count(0) == 1
    rules.write_snapshot({"r": one.union(one)}, folder, 2)
    assert [count(0), count(1), count(1)] == [1, 2, 2]
    rules.write_snapshot({"r": one.where("false")}, folder, 3)
    assert [count(1), count(2)] == [2, 0]
    assert StateTables(notes).has("rules", spark, 1) and not StateTables(notes).has("rules", spark, 0)


# --- several outputs, first sightings, identity -----------------------------------------------------


def test_crash_between_outputs_shows_nothing(spark, tmp_path):
    outputs = Outputs(str(tmp_path))
    rows = spark.range(3).selectExpr("id")
    broken = rows.selectExpr("id", "raise_error('lost') AS x")
    outputs.publish({"a": rows, "b": rows}, 0)
    with pytest.raises(Exception, match="lost"):
        outputs.publish({"a": rows, "b": broken}, 1)
    assert os.path.exists(tmp_path / "a" / "batch=1")
    assert outputs.batches(spark) == [0]
    assert outputs.read(spark, "a", "id long").count() == outputs.read(spark, "b", "id long").count() == 3
    for _ in range(2):
        outputs.publish({"a": rows, "b": rows}, 1)
    assert outputs.batches(spark) == [0, 1]
    assert outputs.read(spark, "a", "id long").count() == 6 and outputs.read(spark, "a", "id long", before=1).count() == 3


def test_two_stages_read_one_output(spark, tmp_path):
    """Both readers of an output see its committed batches only, each batch once."""
    out, got = str(tmp_path / "out"), {"alarms": [], "correlation": []}
    outputs = Outputs(out)
    for batch in range(3):
        outputs.publish({"event": spark.range(batch, batch + 2).selectExpr("id")}, batch)
    spark.range(100, 101).selectExpr("id").write.parquet(f"{out}/event/batch=3")  # not committed
    for name, seen in got.items():
        stage = jobs.committed(lambda rows, _, seen=seen: seen.append(_keys(rows, "id")), out, "event", "id long")
        query = jobs.start(jobs.commit_stream(spark, out), stage, str(tmp_path / name), None)
        query.awaitTermination()
        assert query.exception() is None
    assert sorted(got["alarms"]) == sorted(got["correlation"]) == [[(0,), (1,)], [(1,), (2,)], [(2,), (3,)]]


def test_assets_are_inserted_once(spark, tmp_path):
    flows, registered = frame(spark, SF, "netflow"), frame(spark, SF, "registered")
    stage = jobs.asset_stage(str(tmp_path), lambda s: frame(s, SF, "registered"), MONITORED_RANGES)
    for batch, part in enumerate(_slices(flows, "record_time", 3)):
        stage(part, batch)
        stage(part, batch)  # a replay adds nothing
    made = spark.read.parquet(f"{tmp_path}/asset")
    whole = assets.discover_assets(flows, registered, MONITORED_RANGES)
    columns = ("record_id", "ip", "storage_time")
    assert _keys(made, *columns) == _keys(whole, *columns) != []
    assert made.select("batch").distinct().count() >= 2


def test_equal_messages_keep_their_ids_apart(spark, tmp_path):
    message = frame(spark, SF, "flow_message").limit(1).collect()[0].value
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        spark.createDataFrame([(message,)] * 3, "value string").coalesce(1).write.mode("append").parquet(source)
    stream = readers.file_stream(spark, source, "value string", files_per_batch=1, identity="source_id")
    query = jobs.start(stream, jobs.flow_stage(out, "source_id"), str(tmp_path / "cp"), None)
    query.awaitTermination()
    made = spark.read.parquet(f"{out}/netflow")
    assert made.count() == 12 and made.select("record_id").distinct().count() == 12
