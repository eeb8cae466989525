import datetime as dt

import pytest
from pyspark.sql import functions as F

from secflow.functions.predicates import method_holds
from secflow.operators import alarms, events
from secflow.schemas import EVENT_FIELDS, GENERAL_LOG, GENERAL_FIELDS

T0 = dt.datetime(2024, 1, 1)


def _logs(spark, *rows):
    base = dict.fromkeys(GENERAL_FIELDS)
    data = []
    for i, r in enumerate(rows):
        row = {**base, "record_id": f"g{i}", "first_recv_time": T0, "event_level": 1, "report_app": "app", **r}
        data.append(tuple(row[f] for f in GENERAL_FIELDS))
    return spark.createDataFrame(data, GENERAL_LOG)


@pytest.mark.parametrize("method, begin, value, strict, loose", [
    ("1", "ABC", "abc", True, True), ("1", "a", "b", False, False), ("2", "a", "A", False, False),
    ("3", "b", "A", True, True), ("4", "B", "a", False, False), ("5", "a", "A", True, True), ("6", "9", "10", False, False),
    ("6", "10", "9", True, True), ("7", "b", "a", True, False), ("7", "b", "c", True, True), ("8", "x,y", "Y", True, True),
    ("8", "x,y", "z", True, False), ("9", "needle in hay", "needle", True, True), ("9", "Needle", "needle", False, False),
    ("x", "a", "a", False, False), (None, "a", "a", False, False)])
def test_methods_read_rule_against_field(spark, method, begin, value, strict, loose):
    row = spark.createDataFrame([(method, begin, "d", value)], "m string, b string, e string, x string")
    for mode, expected in ((True, strict), (False, loose)):
        got = row.select(method_holds(F.col("m"), F.col("b"), F.col("e"), F.col("x"), mode).alias("ok")).first().ok
        assert got is expected


def test_builtin_first_definition_wins(spark):
    defs = spark.createDataFrame(
        [(2, "d2", "n2", "2", "LOGIN"), (1, "d1", "n1", "1", " login "), (3, "d3", "n3", "3", "")],
        "rule_ord int, event_rule_id string, event_rule_name string, event_rule_level string, begin_value string")
    logs = _logs(spark, {"event_name": "Login ", "host": "h", "action_result": "ok"}, {"event_name": "other"},
                 {"event_name": None}, {"event_name": "login", "report_app": "NE_FLOW"})
    rows = {r.log_id: r for r in events.builtin_events(logs, defs).collect()}
    assert {k: r.event_rule_id for k, r in rows.items()} == {"g0": "d1", "g2": "d3", "g3": "d1"}
    assert (rows["g0"].is_inner, rows["g3"].is_inner) == ("1", "0")
    assert (rows["g0"].host, rows["g0"].action_opt, rows["g0"].proto, rows["g0"].open_time) == ("h", "ok", "app", T0)
    assert list(rows["g0"].asDict()) == EVENT_FIELDS


DEFS = [(1, "two"), (2, "unknown"), (3, "nofield"), (4, "short"), (5, "all")]
FIELDS = [("two", "Eventname", "1", "LOGIN"), ("two", "destport", "9", "22 80"), ("unknown", "eventname", "q", "login"),
          ("nofield", "nosuch", "2", "zz"), ("short", "e", "2", "zz")]


@pytest.mark.parametrize("compile_rows", [100, 0])
def test_user_events_need_all_conditions(spark, compile_rows):
    defs = spark.createDataFrame(
        [(o, i, f"name {i}", "3") for o, i in DEFS],
        "rule_ord int, event_rule_id string, event_rule_name string, event_rule_level string")
    fields = spark.createDataFrame(
        [(*f, "") for f in FIELDS], "event_rule_id string, field string, method string, begin_value string, end_value string")
    logs = _logs(spark, {"event_name": "login", "dest_port": "80"}, {"event_name": "login", "dest_port": "443"}, {})
    rows = events.user_events(logs, defs, fields, compile_rows=compile_rows).collect()
    assert {r.log_id: r.event_rule_id for r in rows} == {"g0": "two", "g1": "all", "g2": "all"}
    assert {r.is_inner for r in rows} == {"0"} and rows[0].asDict().keys() == dict.fromkeys(EVENT_FIELDS).keys()
    without_all = events.user_events(logs, defs.where("rule_ord < 5"), fields, compile_rows=compile_rows)
    assert [r.log_id for r in without_all.collect()] == ["g0"]


def test_passthrough_and_union(spark):
    logs = _logs(spark, {"event_id": "e1", "event_name": "n", "event_level": 4})
    event = events.passthrough_events(logs, with_log=True)
    row = event.first()
    assert (row.event_rule_id, row.event_rule_name, row.event_rule_level, row.log.event_id) == ("e1", "n", "4", "e1")
    assert events.all_events(event, event).count() == 2


def _policies(spark):
    whole = spark.createDataFrame(
        [("W1", "a", None, None, "3", "1", "T_Siem_Alarm_Policy_Event", "x", 1), ("W2", "b", dt.datetime(2025, 1, 1), None, "1", "1", "t_siem_alarm_policy_event", "x", 1)],
        "record_id string, alarm_name string, start_time timestamp, end_time timestamp, alarm_level string, alert_type string, obj_table string, obj_id string, status int")
    detail = spark.createDataFrame(
        [("p1", " w1", "RULE ", 60, 2), ("p2", "W2", "rule", 60, 1), ("p3", "missing", "rule", 60, 1)],
        "record_id string, alarm_id string, event_rule_id string, control_time int, count int")
    return whole, detail


def test_alarms_count_per_policy(spark):
    events_ = spark.createDataFrame(
        [("Rule", f"e{i}", "名", T0 + dt.timedelta(seconds=i)) for i in range(5)],
        "rule_id string, event_id string, name string, ts timestamp")
    rows = alarms.alarms(events_, *_policies(spark)).collect()
    assert sorted((r.policy_id, r.event_id) for r in rows) == [("p1", "e1"), ("p1", "e3")] + [("p2", f"e{i}") for i in range(5)]
    first = [r for r in rows if r.policy_id == "p1" and r.event_id == "e1"][0]
    assert first.content == "2024-01-01 00:00:01事件【名】发生告警!" and first.obj_id == "W1" and first.alarm_times == 1
    valid = alarms.alarms(events_, *_policies(spark), check_validity=True).collect()
    assert {r.policy_id for r in valid} == {"p1"}


def test_alarm_ids_are_reproducible(spark):
    events_ = spark.createDataFrame(
        [("rule", f"e{i}", "n", T0) for i in range(4)], "rule_id string, event_id string, name string, ts timestamp")
    ids = [sorted(r.record_id for r in alarms.alarms(events_.repartition(k), *_policies(spark)).collect()) for k in (1, 3)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 6
