import re

import pytest
from pyspark.sql import functions as F

from secflow.functions.groups import MARK, compile_pattern
from secflow.functions.text import ip_bounds, ip_in_any, ip_to_long, name_tokens
from secflow.operators import normalize, parse
from secflow.plans import queries
from secflow.plans.tables import frame
from secflow.schemas import GENERAL_FIELDS, USER_GENERAL_FIELDS
from secflow.sources import sinks

# a gateway's format of this test: semicolon fields, of which the extractor knows some by name
GATE_CONTENT = (
    "gate7 deny; name=port sweep; at=1700000000; class=probe; from=192.0.2.15:40022; to=198.51.100.7:8443; "
    "level=5; Proto=17; actor=192.0.2.15; target=198.51.100.7; zone=dmz;west")
GATE_REGEX = (
    r"deny; name=(?<eventName>[^;]+); at=(?<openTime>\d+); class=(?<attackClass>\w+); "
    r"from=(?<sourceIp>[0-9.]+)(?<sourcePort>:\d+); to=(?<destIp>[0-9.]+)(?<destPort>:\d+); "
    r"level=(?<eventLevel>\d); Proto=(?<proto>\d+); actor=(?<attacker>[^;]+); target=(?<victim>[^;]+); "
    r"zone=(?<attackMethod>.*);(?<appId>.*)")


def _rules(spark, *rows):
    ordered = [(o, rule_id, device, regex, *rest) for o, device, regex, rule_id, *rest in rows]
    return spark.createDataFrame(ordered, normalize.RULE_SCHEMA)


def _logs(spark, *rows):
    return spark.createDataFrame(
        [(str(i), ip, content) for i, (ip, content) in enumerate(rows)], "log_id string, report_ip string, content string"
    ).selectExpr(
        "log_id", "timestamp'2024-01-01 00:00:00.5' as recv_time", "report_ip", "'user' as facility",
        "'notice' as severity", "'app' as report_app", "content")


@pytest.mark.parametrize("regex, count, names", [
    (r"a(b)(?<n>c)", 2, {"n": 2}),
    (r"\(x\)(?:y)(?=z)(?!w)(?<=q)(?<!r)(?<v>1)", 1, {"v": 1}),
    (r"[(]([)(]+)[^]()]", 1, {}),
    (r"[]()](a)", 1, {}),
    (r"\Q(a)(\E(?<k>b)", 1, {"k": 1}),
    (r"[a&&[^(b]](c)", 1, {}),
    (r"((?<a>x)|(?<b>y))", 3, {"a": 2, "b": 3}),
    ("plain", 0, {}),
])
def test_group_numbers(regex, count, names):
    compiled = compile_pattern(f" {regex} ")
    assert (compiled.regex, compiled.count, compiled.names) == (regex, count, names)


def test_named_groups_reach_their_columns(spark):
    line = f"a17~2024-03-05 06:07:08~203.0.113.9~local4~warning~gate~{GATE_CONTENT}"
    raw = parse.raw_parse(spark.createDataFrame([(line,)], "value string"))
    rules = _rules(spark, (1, " 203.0.113.9", f" {GATE_REGEX} ", " g1 ", "q-r", None, "gw", "e5"))
    row = normalize.normalize(raw, rules).first()
    assert list(row.asDict()) == GENERAL_FIELDS
    assert row.event_name == "port sweep" and row.open_time == "1700000000"
    assert (row.source_ip, row.source_port, row.dest_ip, row.dest_port) == ("192.0.2.15", "40022", "198.51.100.7", "8443")
    assert (row.proto, row.attacker, row.victim) == ("17", "192.0.2.15", "198.51.100.7")
    assert (row.event_level, row.event_def_id, row.log_rule_id, row.org_id) == (1, "qr", "g1", "a17")
    # group names are case-sensitive, so these stay empty
    assert row.attackmethod is row.appid is None


RULES = [
    (2, "10.0.0.1", r"(?<eventName>\w+) (?<sourceIp>[0-9.]+)(?<sourcePort>:[0-9]+)?", "r2", None, "4", None, None),
    (1, "10.0.0.1", r"(?i)ERR(or)? (?<sourceIp>[0-9.]+)", "r1", None, " ", None, None),
    (3, "10.0.0.2", "nothing captured", "r3", None, "1", None, None),
    (4, "10.0.0.2", r"^a(?<host>.)c$", "r4", None, "1", None, None),
]
LOGS = [
    ("10.0.0.1", "x error 1.2.3.4:55"), (" 10.0.0.1", "login 1.2.3.4:55 tail"), ("10.0.0.1", "login 9.9.9.9"),
    ("10.0.0.2", "nothing captured"), ("10.0.0.2", "abc"), ("10.0.0.3", "login 1.2.3.4"), ("10.0.0.1", None),
    ("10.0.0.1", f"two{MARK}parts login 5.6.7.8:9"), ("10.0.0.1", "line\nbreak login 7.7.7.7:1\nmore"),
    ("10.0.0.2", f"a{MARK}c"),
]
EXPECTED = {
    "0": ("r1", None, "1.2.3.4", None, None, 1), "1": ("r2", "login", "1.2.3.4", "55", None, 4),
    "2": ("r2", "login", "9.9.9.9", None, None, 4), "4": ("r4", None, None, None, "b", 1),
    "7": ("r2", "login", "5.6.7.8", "9", None, 4), "8": ("r2", "login", "7.7.7.7", "1", None, 4),
    "9": ("r4", None, None, None, MARK, 1),
}


@pytest.mark.parametrize("compile_rows", [100, 0])
def test_forms_agree_on_blanks_and_ties(spark, compile_rows):
    """A line break behind a regex is not part of it; rules of one number follow their other columns."""
    rules = _rules(
        spark, (1, "10.0.0.1", "(?<eventName>lo)gin\n", "zz", None, None, None, None),
        (1, "10.0.0.1", "(?<eventName>log)", "aa", None, None, None, None))
    got = normalize.normalize(_logs(spark, ("10.0.0.1", "login")), rules, compile_rows=compile_rows).collect()
    assert [(r.log_rule_id, r.event_name) for r in got] == [("aa", "log")]


def test_too_many_rules_to_compile(spark):
    with pytest.raises(ValueError):
        normalize.match_rules(_logs(spark, *LOGS), _rules(spark, *RULES), compile_rows=2)


@pytest.mark.parametrize("compile_rows", [100, 0])
def test_first_matching_rule_wins(spark, compile_rows):
    """The compiled form and the array form of a rule base give the same logs."""
    rows = normalize.normalize(_logs(spark, *LOGS), _rules(spark, *RULES), compile_rows=compile_rows).collect()
    got = {r.org_id: (r.log_rule_id, r.event_name, r.source_ip, r.source_port, r.host, r.event_level) for r in rows}
    assert got == EXPECTED


@pytest.mark.parametrize("compile_rows", [100, 0])
def test_user_rules_have_no_device(spark, compile_rows):
    rows = normalize.normalize(
        _logs(spark, ("1.1.1.1", "abc"), ("2.2.2.2", "login 1.2.3.4")), _rules(spark, *RULES), False, compile_rows)
    assert rows.columns == USER_GENERAL_FIELDS
    got = {r.org_id: (r.log_rule_id, r.first_recv_time) for r in rows.collect()}
    assert got == {"0": ("r4", 1704067200500), "1": ("r2", 1704067200500)}


@pytest.mark.parametrize("compile_rows", [100, 0])
def test_match_flag_is_zero_for_matched(spark, compile_rows):
    flagged = normalize.flag_matches(normalize.match_rules(_logs(spark, *LOGS), _rules(spark, *RULES), True, compile_rows))
    assert {r.log_id for r in flagged.collect() if r.is_match == 0} == set(EXPECTED)
    assert flagged.count() == len(LOGS)


def test_empty_rule_base_matches_nothing(spark):
    assert normalize.normalize(_logs(spark, *LOGS), _rules(spark)).count() == 0


def test_normalize_needs_no_shuffle(spark):
    logs = frame(spark, "/root/testdata/sf0.001", "raw_log")
    plan = normalize.normalize(logs, _rules(spark, *RULES))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Python" not in plan  # the rules are broadcast
    # the pattern is tested once per log, not again in a pushed-down filter
    assert len(re.findall(r"RLIKE\(", plan)) == 1


def test_raw_parse_edges(spark):
    lines = ["a~2024-01-01 00:00:00~ip~f~s~app~content~~~", "2024-01-01 00:00:00~ip~f~s~app~content", "~~~~~~~", "",
             "no delimiter", "a~b~c", "a~bad time~ip~f~s~app~x~y~z~w~v", None]
    rows = parse.raw_parse(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    got = {(r.content, r.report_ip) for r in rows}
    assert got == {("content", "ip"), ("x", "ip")} and len(rows) == 3
    padded = [r for r in rows if r.content == "content" and r.log_id != "a"][0]
    assert len(padded.log_id) == 32 and padded.report_app == "app"
    assert [r.recv_time for r in rows if r.content == "x"] == [None]


def test_raw_parse_identity_names_the_line(spark):
    line = "2024-01-01 00:00:00~ip~f~s~app~content"
    frame = spark.createDataFrame([(line, "t-0-1"), (line, "t-0-2")], "value string, source_id string")
    ids = {r.log_id for r in parse.raw_parse(frame, identity=F.col("source_id")).collect()}
    assert len(ids) == 2


def test_raw_log_flag_forms(spark):
    base = "i~2024-01-01 00:00:00~ip~f~s~app~c~"
    lines = [base + "0", base + " ", base + "x", base + "7~more", base, "a~b"]
    rows = sinks.raw_log_docs(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(r.ismatch for r in rows) == [0, 0, 1, 7]
    assert {r.recvtime for r in rows} == {1704067200000}


def test_name_tokens(spark):
    rows = spark.createDataFrame([("SQL注入",), (" ",), ("",), (None,)], "n string").select(name_tokens(F.col("n")).alias("t"))
    assert [r.t for r in rows.collect()] == ["socos53socos51socos4csocos6ce8socos5165", "", "", ""]


def test_addresses(spark):
    ips = ["0.0.0.0", "221.176.64.00", "221.176.69.11", "221.176.69.12", "255.255.255.255", "1.2.3", "a.b.c.d", None]
    rows = spark.createDataFrame([(x,) for x in ips], "ip string").select(
        ip_to_long(F.col("ip")).alias("n"), ip_in_any(F.col("ip"), ["221.176.64.0-221.176.69.11"]).alias("inside")).collect()
    assert [r.n for r in rows] == [0, 3719315456, 3719316747, 3719316748, 4294967295, None, None, None]
    assert [r.inside for r in rows] == [False, True, True, False, False, False, False, False]
    assert ip_bounds("0.0.1.0-1.0.0.0") == (256, 16777216)


def test_flow_json(spark):
    lines = ['[{"SrcIP":"a","srcip":"b","N":1},{"X":null}]', '[]', ' ', '[{"RecordID":"mine","k":"v"}]']
    rows = parse.flow_json_explode(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    flows = sorted((r.flow for r in rows), key=lambda f: sorted(f))
    for r in rows:
        assert r.flow["recordid"] == r.record_id
    bare = sorted([{k: v for k, v in f.items() if k != "recordid"} for f in flows], key=str)
    assert bare == sorted([{"srcip": "b", "n": "1"}, {"x": None}, {"k": "v"}], key=str)
    assert len({r.record_id for r in rows}) == 3


def test_app_flow_lines(spark):
    lines = ['HDR {"SRCIP": "1.1.1.1", "Note": "two words"}', "HDR", "HDR ", 'HDR not-json', ' {"A": "b"}']
    rows = parse.appflow_line_parse(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    flows = [{k: v for k, v in r.flow.items() if k != "recrodid"} for r in rows]
    assert {"srcip": "1.1.1.1", "note": "twowords"} in flows and {"a": "b"} in flows
    assert all(r.flow["recrodid"] == r.record_id for r in rows)


def test_condition_atoms(spark):
    rules = spark.createDataFrame([("r", " sourceip :0:1.1.1.1~:bad~:a:b~:destport:2:80~:x:1:2:3")], "rule_id string, condition_exp string")
    got = [(r.atom_field, r.atom_op, r.atom_value) for r in parse.condition_atoms(rules).collect()]
    assert got == [("sourceip", "0", "1.1.1.1"), ("destport", "2", "80")]


def test_general_lines_fill_blanks(spark):
    rows = normalize.normalize(_logs(spark, ("10.0.0.2", "abc")), _rules(spark, *RULES))
    line = sinks.general_log_lines(rows).first().value.split("~")
    assert len(line) == 37 and line[0] == line[1] and line[5] == " " and line[32] == "b"
    assert line[2] == "2024-01-01 00:00:00"


def test_equal_lines_get_their_own_ids(spark, monkeypatch):
    monkeypatch.setattr(parse, "_COPIES", 4)
    lines = spark.createDataFrame([("2024-01-01 00:00:00~ip~f~s~app~same",)] * 11 + [("2024-01-01 00:00:00~ip~f~s~app~other",), (None,)], "value string")
    named = parse.with_occurrence(lines)
    ids = sorted(r.source_id for r in named.collect())
    assert len(set(ids)) == 13 and ids == sorted(r.source_id for r in parse.with_occurrence(lines.repartition(3)).collect())
    rows = parse.raw_parse(named, identity=F.col("source_id")).collect()
    assert len(rows) == 12 and len({r.log_id for r in rows}) == 12


@pytest.mark.parametrize("name", ["raw_parse", "flow_json_explode", "appflow_line_parse"])
def test_ids_are_unique(spark, name):
    rows = queries.registry()[name](spark, "/root/testdata/sf0.001")
    key = "log_id" if name == "raw_parse" else "record_id"
    assert rows.count() == rows.select(key).distinct().count() > 0
