"""Required text of regexes, and matching through its index."""

import re

import pytest
from pyspark.sql import functions as F

from secflow.functions.literals import BUCKETS, bucket, gram_index, required_literals
from secflow.operators import normalize
from secflow.plans.tables import frame

SF = "/root/testdata/sf0.001"

KNOWN = {
    "src=192[.]168[.]1[.]2:(?<port>[0-9]+)": ["src=192.168.1.2:"],
    "evt=(?<name>a|b) src=(?<x>[0-9.]+)": ["evt=", " src="],
    "(ab|cd)": [], "a|b": [], "(?i)abc": [], "\\x41bcdef": [], "[a&&b]cdefg": [], "ab(cd": [],
    "abcd?ef+gh": ["abc", "ef", "gh"], "(?:abcd)?xy": ["xy"], "x{2}yz": ["yz"], "a++bcd": ["a", "bcd"],
    "\\Qa.b*\\E*zz": ["a.b", "zz"], "[^a]bcd[]a]efghi": ["bcd", "efghi"], "[a[b]c]defg": ["defg"],
    "(?=foo)bar(?!bazbaz)": ["bar"], "a\\.b\\d+cdef": ["a.b", "cdef"], "": [],
}


@pytest.mark.parametrize("regex", list(KNOWN))
def test_required_literals(regex):
    assert sorted(required_literals(regex)) == sorted(KNOWN[regex])


def test_every_match_holds_the_literals():
    """Random regexes over random texts: whatever matches contains all literals."""
    import random

    rng, checked = random.Random(7), 0
    atoms = ["a", "b", "ab", "[ab]", "[.]", "\\.", ".", "(a)", "(ab|b)", "(?:ba)", "(?=a)", "(?!b)", "(a(b)a)", "\\w"]
    for _ in range(3000):
        regex = "".join(rng.choice(atoms) + rng.choice(["", "", "", "?", "*", "+", "{2}", "+?", "*+"]) for _ in range(4))
        regex = regex.replace("(?=a)+", "(?=a)").replace("(?!b)*", "(?!b)")
        if rng.random() < 0.1:
            regex += "|" + rng.choice(atoms)
        try:
            pattern = re.compile(regex)
        except re.error:
            continue
        literals = required_literals(regex)
        for _ in range(5):
            text = "".join(rng.choice("ab.") for _ in range(rng.randrange(9)))
            if pattern.search(text):
                checked += 1
                assert all(t in text for t in literals), (regex, text, literals)
    assert checked > 1000


def test_index_takes_the_rarest_gram():
    table, literals = gram_index([["evt=", "user7"], ["evt="], ["evt=", "ab"], ["abc"], []])
    assert literals == ["user7", "evt=", "evt=", "", ""]
    assert table[bucket("evt=")] == [1, 2] and sum(map(len, table)) == 3 and len(table) == BUCKETS


def test_index_equals_trying_in_order(spark):
    rules = [
        (3, "late=(?<eventName>[a-z]+)", "r3"), (1, "user[.]one (?<sourceIp>[0-9.]+)", "r1"), (2, "(?<eventName>x|y)z", "r2"),
        (2, "tied=(?<eventName>.*)", "r2a"), (2, "tied=(?<destIp>.*)", "r2b"), (None, "none=(?<eventName>.)", "r0"),
        (4, "no group here", "r4"), (5, "café \U0001f600 (?<eventName>.+)", "r5"), (6, "(?i)LOUD (?<eventName>.+)", "r6"),
        (7, None, "r7")]
    table = spark.createDataFrame([(a, "", b, c) for a, b, c in rules], "rule_ord int, device_ip string, log_regex string, log_rule_id string")
    texts = ["late=abc user.one 1.2.3.4", "userXone 1.2.3.4", "xz", "tied=a", "none=b", "no group here", "café \U0001f600 ok",
             "loud noise", "", None, "ab", "late=", "x" * 200_000 + " late=end", "a\u001fb late=q"]
    logs = spark.createDataFrame([(i, t, "10.0.0.1") for i, t in enumerate(texts)], "log_id int, content string, report_ip string")
    indexed = normalize.match_rules(logs, table, device_scoped=False)
    in_order = normalize._array_match(logs, normalize._rule_columns(table, False), False)
    rows = lambda df: sorted((r.log_id, r.hit) for r in df.select("log_id", "hit").collect())
    assert [r.hit and r.hit.log_rule_id for r in indexed.orderBy("log_id").collect()][:4] == ["r1", None, "r2", "r2a"]
    assert [(i, h and h.asDict()) for i, h in sorted(rows(indexed), key=lambda x: x[0])] == [
        (i, h and h.asDict()) for i, h in sorted(rows(in_order), key=lambda x: x[0])]
    assert normalize.match_rules(logs, table.where("false"), device_scoped=False).where("hit.rule_ord is not null").count() == 0


def test_few_rules_are_tried(spark):
    """Of a rule a customer, a log meets only those whose text it may hold, without a shuffle."""
    logs, rules = frame(spark, SF, "raw_log"), frame(spark, SF, "user_log_rule_large")
    known = [r.log_regex for r in rules.orderBy("rule_ord").collect()]
    table, literals = gram_index([required_literals(r) for r in known])
    apart = sum(not t for t in literals)
    tried = logs.select(F.size(normalize.candidate_rules(F.col("content"), table, literals)).alias("n"))
    got = tried.agg(F.max("n").alias("most"), F.avg("n").alias("mean")).first()
    assert len(known) >= 100 and apart <= len(known) // 50 + 1
    assert got.mean < apart + len(known) / 20
    plan = normalize.match_rules(logs, rules, device_scoped=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_larger_base_than_the_index_is_joined(spark, monkeypatch):
    """Beyond the index rules meet texts by their grams; none is tried on every log, and the result is the same."""
    rules = [
        (3, "late=(?<eventName>[a-z]+)", "r3"), (1, "user[.]one and more (?<sourceIp>[0-9.]+)", "r1"), (2, "(?<eventName>x|y)z", "r2"),
        (2, "tied=(?<eventName>.*)", "r2a"), (2, "tied=(?<destIp>.*)", "r2b"), (1, " tied=(?<eventName>.*)", "r1b"),
        (None, "none=(?<eventName>.)", "r0"), (4, "no group here", "r4"), (5, "café \U0001f600 (?<eventName>.+)", "r5"),
        (6, "(?i)LOUD (?<eventName>.+)", "r6"), (7, None, "r7"), (8, "late=(?<eventName>[a-z]+)", "r8")]
    table = spark.createDataFrame([(a, "", b, c) for a, b, c in rules], "rule_ord int, device_ip string, log_regex string, log_rule_id string")
    texts = ["late=abc user.one and more 1.2.3.4", "userXone and more 1.2", "xz", "tied=a", "none=b xz", "no group here", "tied=a",
             "café \U0001f600 ok", "loud noise", "", None, None, "ab", "late=", "x" * 2_000 + " late=end", "a\u001fb late=q"]
    logs = spark.createDataFrame([(i % 14, t, "10.0.0.1") for i, t in enumerate(texts)], "log_id int, content string, report_ip string")
    in_order = normalize._array_match(logs, normalize._rule_columns(table, False), False)
    key = lambda h: None if h is None or h.captures is None else tuple(h.asDict().items())
    rows = lambda df: sorted(((r.log_id, r.content, str(key(r.hit))) for r in df.collect()), key=str)
    expected = rows(in_order)
    assert rows(normalize.match_rules(logs, table, device_scoped=False)) == expected
    monkeypatch.setattr(normalize, "INDEX_RULES", 3)
    monkeypatch.setattr(normalize, "_array_match", None)
    assert rows(normalize.match_rules(logs, table, device_scoped=False)) == expected
    short = table.where("log_rule_id in ('r1', 'r3', 'r5', 'r8', 'r2a')")
    monkeypatch.setattr(normalize, "INDEX_RULES", 0)
    assert normalize.match_rules(logs, short, device_scoped=False).where("hit.rule_ord is not null").count() == 6


def test_rules_of_one_regex_are_one(spark):
    """A base that repeats its regexes stays in the index; the first rule of each decides."""
    rules = spark.range(60_000).selectExpr(
        "cast(60000 - id as int) rule_ord", "'' device_ip", "concat('key=', id % 50, ';(?<eventName>.*)') log_regex",
        "concat('r', 60000 - id) log_rule_id")
    logs = spark.createDataFrame([(1, "key=7;a", "x"), (2, "key=51;a", "x")], "log_id int, content string, report_ip string")
    matched = normalize.match_rules(logs, rules, device_scoped=False)
    assert [r.hit and r.hit.log_rule_id for r in matched.orderBy("log_id").collect()] == ["r43", None]
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
