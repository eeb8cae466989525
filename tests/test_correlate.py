"""Composite events against a plain sequential simulation."""

import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from secflow.functions.search import count_at_most
from secflow.operators import alarms, correlate
from secflow.plans.tables import composite_rules, context, corr_events

SF = "/root/testdata/sf0.01"


def _dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def _hit(rule, event):
    if rule["flag"] == 0:
        return rule["event_id"] == event["event_rule_id"]
    if event["is_inner"] != "1":
        return False
    value = {"destport": event["dest_port"], "eventname": event["event_rule_name"]}[rule["field_name"].lower()].lower()
    wanted = rule["field_value"].lower()
    return {"1": value == wanted, "2": value != wanted}[rule["field_op"]]


def _simulate(spark):
    rules, ctx = composite_rules(spark, SF), context(spark, SF)
    events = sorted(_dicts(corr_events(spark, SF)), key=lambda e: (e["open_time"], e["event_result_id"]))
    scans = _dicts(ctx.scans)
    leak = {s["ne_ip"] for s in scans}
    cve = {(s["ne_ip"], s["leak_cve"].lower()) for s in scans}
    port = {(s["ne_ip"], s["leak_port"]) for s in scans}
    intel = {r["attack_ip"] for r in _dicts(ctx.intel)}
    stats = sorted((r["stat_time"], r["bytes"]) for r in _dicts(ctx.flow_stats))
    times = [t for t, _ in stats]
    os = {}
    assets = {a["ne_id"]: a["os_id"] for a in _dicts(ctx.assets)}
    for i in sorted(_dicts(ctx.asset_ips), key=lambda r: r["ne_id"]):
        os[i["device_ip"]] = assets[i["ne_id"]]

    def flow_ok(rule, e):
        before = stats[:bisect.bisect_right(times, e["open_time"])][-1:]
        period = dt.timedelta(seconds=correlate.PERIODS[rule["statis_period"]])
        if not before or e["open_time"] - before[-1][0] > period or before[-1][1] >= rule["flow_limit"]:
            return False
        fields = {"sourceip": "source_ip", "sourceport": "source_port", "destip": "dest_ip", "destport": "dest_port"}
        for atom in filter(None, rule["condition_exp"].split("~:")):
            parts = atom.split(":")
            if len(parts) == 3:
                x, v = e[fields[parts[0].strip()]], parts[2]
                if not {"0": x == v, "1": x > v, "2": x < v}[parts[1]]:
                    return False
        return True

    def asset_ok(rule, e):
        ip = {2: e["source_ip"], 3: e["dest_ip"]}[rule["ip_type"]]
        return ip == rule["ip_addr"].strip() and os.get(ip, 1) == rule["os"]

    def leak_ok(rule, e):
        ip = e["dest_ip"]
        return ((rule["cve_match"] == 1 and (ip, e["cve"].lower()) in cve) or (rule["leak_match"] == 1 and ip in leak)
                or (rule["port_match"] == 1 and (ip, e["dest_port"]) in port))

    tables = {n: _dicts(getattr(rules, n)) for n in ("defs", "subs", "details", "leaks", "flows", "assets", "intels")}
    fired, members = [], {}
    for d in tables["defs"]:
        if d["status"] != 1:
            continue
        subs = sorted((s for s in tables["subs"] if s["status"] == 1 and s["me_define_id"].strip() == d["record_id"]),
                      key=lambda s: (s["obj_table"].upper(), s["record_id"]))
        of = {s["record_id"]: [m for m in tables["details"] if m["med_id"] == s["record_id"]]
              for s in subs if s["obj_table"].upper() == correlate.DETAIL}
        counts, since = {}, []
        for e in events:
            hits = [m for ms in of.values() for m in ms if _hit(m, e)]
            if not hits:
                continue
            since.append(e)
            for m in hits:
                counts[m["record_id"]] = counts.get(m["record_id"], 0) + 1
            reached = {m["record_id"] for m in hits if counts[m["record_id"]] >= m["times"]}
            holds = True
            for s in subs:
                mine = lambda t: [r for r in tables[t] if r["med_id"] == s["record_id"]]  # noqa: B023, E731
                kind = s["obj_table"].upper()
                if kind == correlate.DETAIL:
                    ok = all(m["record_id"] in reached for m in of[s["record_id"]])
                elif kind == correlate.LEAK:
                    ok = all(any(leak_ok(r, x) for x in since) for r in mine("leaks"))
                elif kind == correlate.FLOW:
                    ok = all(flow_ok(r, e) for r in mine("flows"))
                elif kind == correlate.ASSET:
                    ok = all(asset_ok(r, e) for r in mine("assets"))
                else:
                    ok = all(r["ip_match"] == 1 and e["source_ip"] in intel for r in mine("intels"))
                holds = (holds or ok) if s["op"] == 1 else (holds and ok)
            if holds and reached:
                fired.append((d["record_id"], e["event_result_id"]))
                members[fired[-1]] = {x["event_result_id"] for x in since}
                counts, since = {}, []
    return fired, members


def test_composites_equal_simulation(spark):
    fired, members = _simulate(spark)
    chained = correlate.composite_events(
        correlate.definition_floors(corr_events(spark, SF), composite_rules(spark, SF), context(spark, SF)))
    got = chained.where("fired").select("def_id", "event_result_id").collect()
    assert sorted((r.def_id, r.event_result_id) for r in got) == sorted(fired)
    assert {"d1", "d2", "d3", "d4", "d7", "d9"} <= {d for d, _ in fired}

    rows = correlate.composite_rows(chained)
    ids = {r.record_id: r for r in rows.collect()}
    assert len(ids) == len(fired)
    linked = {}
    for m in correlate.composite_members(chained).collect():
        linked.setdefault(m.composite_id, set()).add(m.event_result_id)
    assert set(linked) == set(ids)
    assert sorted(map(sorted, linked.values())) == sorted(map(sorted, members.values()))
    flow = [r for r in ids.values() if r.event_rule_id is not None]
    assert flow and all(r.source_ip and r.event_rule_name for r in flow) and len(flow) < len(ids)


def test_field_rules_as_data_equal_compiled(spark):
    rules = composite_rules(spark, SF)
    events = corr_events(spark, SF)
    compiled, data = (
        {(r.event_result_id, h.detail_id) for r in correlate.event_hits(events, rules, compile_rows=n).collect() for h in r.hits}
        for n in (100, 0))
    assert compiled == data and compiled


def test_asof_takes_latest_at_or_before(spark):
    t = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(f"e{i}", t + dt.timedelta(seconds=s)) for i, s in enumerate([0, 5, 9, 10, 100])],
        "event_result_id string, open_time timestamp")
    stats = spark.createDataFrame(
        [(t + dt.timedelta(seconds=s), b) for s, b in [(5, 1), (9, 7), (9, 3), (11, 4)]], "stat_time timestamp, bytes long")
    got = {r.event_result_id: r.stat_bytes for r in correlate.flow_asof(events, stats).collect()}
    assert got == {"e0": None, "e1": 1, "e2": 7, "e3": 7, "e4": 4}


def test_unknown_asset_counts_as_first_os(spark):
    rules = spark.createDataFrame(
        [("r1", "m", 2, "1.1.1.1", 1), ("r2", "m", 2, "1.1.1.1", 2), ("r3", "m", 3, " 2.2.2.2 ", 2), ("r4", "m", 1, "1.1.1.1", 1)],
        "record_id string, med_id string, ip_type int, ip_addr string, os int")
    assets = spark.createDataFrame([(1, 2), (2, 5)], "ne_id int, os_id int")
    ips = spark.createDataFrame([(1, "2.2.2.2")], "ne_id int, device_ip string")
    events = spark.createDataFrame([("e", "1.1.1.1", "2.2.2.2")], "event_result_id string, source_ip string, dest_ip string")
    got = {r.rule_id for r in correlate.asset_matches(events, rules, assets, ips).collect()}
    assert got == {"r1", "r3"}


@pytest.mark.parametrize("ops, oks, expected", [
    ((0, 0), (True, False), False), ((0, 1), (False, True), True), ((1, 0), (True, False), False),
    ((0, 1), (True, False), True), ((7, 0), (True, True), True), ((1,), (False,), True), ((), (), True)])
def test_fold_starts_true_and_keeps_order(spark, ops, oks, expected):
    rows = spark.createDataFrame([([(o, k) for o, k in zip(ops, oks)],)], "subs array<struct<op:int,ok:boolean>>")
    floor = rows.select(correlate.fold_subs(
        F.col("subs"), lambda s: F.when(s["ok"], F.lit(correlate.ALWAYS)).otherwise(F.lit(0)).cast("long")).alias("f")).first().f
    assert (floor > 0) is expected


def test_composite_alarms_read_the_composite_rule(spark):
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("c1", "D1", "name", t)], "record_id string, me_def_id string, name string, storage_time timestamp")
    whole = spark.createDataFrame(
        [("W", "a", None, None, "1", "1", "T_SIEM_ALARM_POLICY_RELATION_EV", "o", 1)],
        "record_id string, alarm_name string, start_time timestamp, end_time timestamp, alarm_level string, alert_type string, obj_table string, obj_id string, status int")
    detail = spark.createDataFrame(
        [("p", "W", "d1 ", 60, 1)], "record_id string, alarm_id string, relation_event_rule_id string, control_time int, count int")
    alarm = alarms.alarms(alarms.from_composites(rows), whole, detail, alarms.COMPOSITE).first()
    assert alarm.content == "2024-01-01 00:00:00联合事件【name】发生告警!"


def test_asof_at_any_distance(spark):
    """Equal times, gaps of many buckets, events before the first and after the last statistic, null times."""
    stats = [(0, 1), (10, 2), (10, 7), (59, 3), (60, 4), (500, 5), (501, None), (3000, 6)]
    events = [-100, -1, 0, 9, 10, 11, 58, 59, 60, 119, 120, 300, 499, 500, 501, 700, 2999, 3000, 9999, None]
    shift = 1_700_000_003
    moment = lambda s: None if s is None else dt.datetime.fromtimestamp(s + shift, dt.timezone.utc)
    lookup = spark.createDataFrame([(moment(t), b) for t, b in stats], "stat_time timestamp, bytes long")
    given = spark.createDataFrame([(str(k), moment(t)) for k, t in enumerate(events)], "event_result_id string, open_time timestamp")
    latest = {}
    for t, b in stats:
        latest[t] = max([x for x in (latest.get(t), b) if x is not None], default=None)
    for seconds in (60, 3600):
        got = {r.event_result_id: r for r in correlate.flow_asof(given, lookup, seconds=seconds).selectExpr(
            "event_result_id", f"unix_seconds(stat_time) - {shift} AS t", "stat_bytes AS b").collect()}
        assert len(got) == len(events)
        for k, t in enumerate(events):
            before = [x for x in latest if t is not None and x <= t]
            expected = (max(before), latest[max(before)]) if before else (None, None)
            assert (got[str(k)].t, got[str(k)].b) == expected, t
    assert correlate.flow_asof(given, lookup.where("false")).where("stat_time IS NULL").count() == len(events)


def test_asof_leaves_events_in_place(spark):
    """With a small lookup the plan has no shuffle: events are neither hashed nor sorted."""
    seen = correlate.flow_asof(corr_events(spark, SF), context(spark, SF).flow_stats)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    body = plan.split("Subquery")[0]
    assert "BroadcastHashJoin" in body and "hashpartitioning" not in body and "rangepartitioning" not in body


def test_asof_searches_once(spark):
    """An event's bucket is halved once, on a plain number."""
    seen = correlate.flow_asof(corr_events(spark, SF), context(spark, SF).flow_stats).select("stat_bytes")
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence(") == 1 and "named_struct(lo" not in plan


def test_search_in_arrays_of_any_size(spark):
    """Places of every value in sorted arrays of 0 to 9 numbers, with ties; null arrays and values count nothing."""
    arrays = [sorted(x // 2 for x in range(n)) for n in range(10)]
    rows = [([(x,) for x in a], v) for a in arrays for v in range(-1, 6)] + [(None, 1), ([(1,)], None)]
    df = spark.createDataFrame(rows, "seen array<struct<t:int>>, v int").withColumn("n", count_at_most("seen", "t", "v"))
    for r in df.collect():
        assert r.n == (0 if r.seen is None or r.v is None else sum(x.t <= r.v for x in r.seen))


def test_leak_lookup_is_one_join(spark):
    flagged = correlate.leak_flags(corr_events(spark, SF), context(spark, SF).scans)
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    scans = spark.createDataFrame(
        [("A.1", None, "80"), ("a.1", "CVE-1", None), ("a.1", "cve-1", "80"), (None, "cve-2", "22")],
        "ne_ip string, leak_cve string, leak_port string")
    rows = spark.createDataFrame(
        [("1", "a.1", "80", "CVE-1"), ("2", "A.1", "22", None), ("3", None, "22", "cve-2"), ("4", "b", "80", "cve-1")],
        "id string, dest_ip string, dest_port string, cve string")
    got = {r.id: (r.has_leak, r.has_cve, r.has_port) for r in correlate.leak_flags(rows, scans).collect()}
    no = (False, False, False)
    assert got == {"1": (True, True, True), "2": (True, False, False), "3": no, "4": no}
