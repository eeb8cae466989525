"""Raw logs to general logs through a regex rule base; the first matching rule in order wins.

Rules are applied inside the scan: no shuffle and no row per (log, rule) pair. A rule base
travels as an ordered array per device address, or, if it holds for every device, as an index of
the text that its rules require (a base too large for an index is joined by that text); evaluation stops at the first match, and one replace yields every capture.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.functions.groups import MARK, compile_pattern
from secflow.functions.literals import BUCKETS, GRAMS, gram_index, grams_of, join_grams, required_literals
from secflow.functions.text import blank_to_null, stable_id
from secflow.plans.physical import (
    broadcast_if_bounded, checkpointed, collect_bounded, collect_to_compile, evaluated_once)
from secflow.schemas import CAPTURES, GENERAL_FIELDS, USER_GENERAL_FIELDS

_RULE_CONSTANTS = ["log_rule_id", "event_def_id", "event_level", "report_ne_type", "event_id"]
_HIT = "struct<rule_ord:bigint," + "".join(f"{c}:string," for c in _RULE_CONSTANTS) + "captures:array<string>>"
_RULE = "struct<rule_ord:bigint,regex:string,idx:array<int>," + ",".join(f"{c}:string" for c in _RULE_CONSTANTS) + ">"
_COMPILED = "struct<regex:string,whole:string,template:string,idx:array<int>,group_count:int>"
_ORDER = ("rule_ord", *_RULE_CONSTANTS, "regex")
_INDEXED = "struct<rule_ord:bigint,regex:string,whole:string,template:string,literal:string,idx:array<int>," + ",".join(
    f"{c}:string" for c in _RULE_CONSTANTS) + ">"
#: A rule base for every device is indexed up to this many different regexes; a larger one is joined.
INDEX_RULES = 50_000
INDEX_BYTES = 32 * 1024 * 1024


def _ordered(rules: list) -> list:
    """Rules as the array form orders them: nulls first, then by every column in turn."""
    key = lambda r: [(r[c] is not None, r[c]) if r[c] is not None else (False,) for c in _ORDER]
    return sorted(rules, key=key)


def _rule_columns(rules: DataFrame, device_scoped: bool) -> DataFrame:
    """Rule rows with trimmed keys; constants a rule base lacks are NULL."""
    have = set(rules.columns)
    constants = [(F.trim(c) if c == "log_rule_id" else F.col(c)).cast("string").alias(c)
                 if c in have else F.lit(None).cast("string").alias(c) for c in _RULE_CONSTANTS]
    device = F.trim("device_ip") if device_scoped else F.lit("")
    return rules.select(
        F.col("rule_ord").cast("long"), device.alias("device"), *constants, F.trim("log_regex").alias("regex")
    ).where("device is not null and regex is not null")


def _compile(regex):
    c = compile_pattern(regex)
    return c.regex, c.whole, c.template, c.indexes, c.count


def _captures(content: Column, one_pass: Column, rule: str) -> Column:
    """Captures of the one-pass form, or group by group for text that itself holds the separator."""
    extract = lambda i: F.call_function("regexp_extract", content, F.col(f"{rule}.regex"), i)
    singly = F.transform(F.col(f"{rule}.idx"), lambda i: F.when(i >= 0, extract(i)).otherwise(F.lit("")))
    return F.when(F.contains(content, F.lit(MARK)), singly).otherwise(one_pass)


def _hit(rule: str, captures: Column) -> Column:
    return F.struct(
        F.col(f"{rule}.rule_ord").alias("rule_ord"), *[F.col(f"{rule}.{c}").alias(c) for c in _RULE_CONSTANTS],
        captures.alias("captures"))


def _compiled_match(logs: DataFrame, rules: list, device_scoped: bool) -> DataFrame:
    content = F.col("content")
    compiled = [(r, compile_pattern(r.regex)) for r in _ordered(rules)]
    compiled = [(r, p) for r, p in compiled if p.count > 0]
    if not compiled:
        return logs.withColumn("hit", F.lit(None).cast(_HIT))
    by_device: dict[str, Column] = {}
    for number, (rule, pattern) in enumerate(compiled):
        test = F.rlike(content, F.lit(pattern.regex))
        chain = by_device.get(rule.device, F)
        by_device[rule.device] = chain.when(test, F.lit(number))
    if device_scoped:
        chosen = F
        for device, chain in by_device.items():
            chosen = chosen.when(F.trim("report_ip") == F.lit(device), chain)
    else:
        chosen = by_device[""]
    table = [{
        "rule_ord": r.rule_ord, "regex": p.regex, "idx": p.indexes, **{c: r[c] for c in _RULE_CONSTANTS},
    } for r, p in compiled]
    # the rule table is one constant, looked up by number
    constants = F.from_json(F.lit(json.dumps(table)), f"array<{_RULE}>")
    matched = evaluated_once(logs, "rule_no", chosen).withColumn("rule", F.get(constants, F.col("rule_no")))
    one_pass = F
    for n, (_, p) in enumerate(compiled):
        replaced = F.regexp_replace(content, F.lit(p.whole), F.lit(p.template))
        one_pass = one_pass.when(F.col("rule_no") == n, F.split(replaced, MARK))
    return matched.withColumn("hit", _hit("rule", _captures(content, one_pass, "rule"))).drop("rule_no", "rule")


def _array_match(logs: DataFrame, rules: DataFrame, device_scoped: bool) -> DataFrame:
    content = F.col("content")
    # on rule rows only, never on logs
    compiled = F.udf(_compile, _COMPILED)("regex")
    prepared = rules.withColumn("p", compiled).where("p.group_count > 0").drop("regex").select("*", "p.*")
    rule = F.struct("rule_ord", *_RULE_CONSTANTS, "regex", "whole", "template", "idx")
    lists = prepared.groupBy("device").agg(F.array_sort(F.collect_list(rule)).alias("rules"))
    if device_scoped:
        logs = logs.join(broadcast_if_bounded(lists), F.trim("report_ip") == F.col("device"), "left").drop("device")
    else:
        logs = logs.withColumn("rules", lists.select("rules").scalar())
    # later rules are not tried once one has matched
    place = F.aggregate(
        F.sequence(F.lit(0), F.size("rules") - 1), F.lit(-1),
        lambda found, k: F.when(found >= 0, found).when(F.rlike(content, F.get("rules", k)["regex"]), k).otherwise(found))
    first = F.get("rules", place)
    matched = evaluated_once(logs, "rule", first).drop("rules")
    one_pass = F.split(F.regexp_replace(content, F.col("rule.whole"), F.col("rule.template")), MARK)
    return matched.withColumn("hit", _hit("rule", _captures(content, one_pass, "rule"))).drop("rule")


def candidate_rules(content: Column, table: list[list[int]], literals: list[str]) -> Column:
    """Places, ascending, of the rules whose gram a text holds, and of those without one.

    The text's grams are looked up in a constant table, so the work follows the text and its hits, not
    the number of rules.
    """
    held = F.from_json(F.lit(json.dumps(table)), "array<array<int>>")
    always = F.from_json(F.lit(json.dumps([k for k, t in enumerate(literals) if not t])), "array<int>")
    grams = F.array_distinct(F.regexp_extract_all(content, F.lit(GRAMS), F.lit(1)))
    found = F.flatten(F.transform(grams, lambda g: F.get(held, F.pmod(F.crc32(g), F.lit(BUCKETS)).cast("int"))))
    return F.array_sort(F.array_distinct(F.concat(always, found)))


def _indexed_match(logs: DataFrame, rules: list) -> DataFrame:
    content = F.col("content")
    compiled = [(r, compile_pattern(r.regex)) for r in _ordered(rules)]
    compiled = [(r, p) for r, p in compiled if p.count > 0]
    if not compiled:
        return logs.withColumn("hit", F.lit(None).cast(_HIT))
    index, literals = gram_index([required_literals(p.regex) for _, p in compiled])
    table = [{
        "rule_ord": r.rule_ord, "regex": p.regex, "whole": p.whole, "template": p.template, "literal": t,
        "idx": p.indexes, **{c: r[c] for c in _RULE_CONSTANTS}} for (r, p), t in zip(compiled, literals, strict=True)]
    constants = F.from_json(F.lit(json.dumps(table)), f"array<{_INDEXED}>")

    def holds(k: Column) -> Column:
        rule = F.get(constants, k)
        return F.contains(content, rule["literal"]) & F.rlike(content, rule["regex"])

    # later rules are not tried once one has matched
    place = F.aggregate(
        candidate_rules(content, index, literals), F.lit(-1),
        lambda found, k: F.when(found >= 0, found).when(holds(k), k).otherwise(found))
    matched = evaluated_once(logs, "rule_no", place).withColumn("rule", F.get(constants, F.col("rule_no")))
    one_pass = F.split(F.regexp_replace(content, F.col("rule.whole"), F.col("rule.template")), MARK)
    return matched.withColumn("hit", _hit("rule", _captures(content, one_pass, "rule"))).drop("rule_no", "rule")


def _first_rules(rules: DataFrame) -> DataFrame:
    """The first rule of each regex: later ones of the same text match the same logs and never decide."""
    return rules.groupBy("device", "regex").agg(F.min(F.struct(*_ORDER)).alias("r")).select("device", "r.*")


def _joined_match(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules meet the texts by one gram each, the one that fewest rules share; those without one are tried in order."""
    content = F.col("content")
    # on rule rows only, never on logs
    compiled = rules.withColumn("p", F.udf(_compile, _COMPILED)("regex")).where("p.group_count > 0")
    grams = F.udf(lambda regex: join_grams(required_literals(regex)), "array<string>")("p.regex")
    prepared = checkpointed(compiled.select(
        F.struct("rule_ord", *_RULE_CONSTANTS, "p.regex", "p.whole", "p.template", "p.idx").alias("rule"),
        grams.alias("grams")))
    every = prepared.select("rule", F.explode("grams").alias("gram"))
    least = F.min(F.struct("shared", "gram")).alias("least")
    chosen = every.join(every.groupBy("gram").agg(F.count("*").alias("shared")), "gram").groupBy("rule").agg(least)
    keyed = chosen.select(F.col("least.gram").alias("gram"), "rule")
    # a rule looks at the text only, so a text is tried once
    texts = logs.select("content").where("content is not null").distinct()
    found = texts.select("content", F.explode(grams_of(content)).alias("gram")).join(broadcast_if_bounded(keyed), "gram")
    by_gram = found.where(F.rlike(content, F.col("rule.regex"))).groupBy("content").agg(F.min("rule").alias("by_gram"))
    others = prepared.where(F.size("grams") == 0).agg(F.array_sort(F.collect_list("rule")).alias("others"))
    tried = texts.withColumn("others", others.scalar())
    # later rules are not tried once one has matched
    place = F.aggregate(
        F.when(F.size("others") > 0, F.sequence(F.lit(0), F.size("others") - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(-1), lambda at, k: F.when(at >= 0, at).when(F.rlike(content, F.get("others", k)["regex"]), k).otherwise(at))
    in_order = evaluated_once(tried, "in_order", F.get("others", place)).where("in_order is not null").select(
        "content", "in_order")
    first = by_gram.join(in_order, "content", "full").select(
        F.col("content").alias("_content"), F.least("by_gram", "in_order").alias("rule"))
    matched = logs.join(first, content == F.col("_content"), "left").drop("_content")
    one_pass = F.split(F.regexp_replace(content, F.col("rule.whole"), F.col("rule.template")), MARK)
    return matched.withColumn("hit", _hit("rule", _captures(content, one_pass, "rule"))).drop("rule")


def match_rules(
    logs: DataFrame, rules: DataFrame, device_scoped: bool = True, compile_rows: int = 0
) -> DataFrame:
    """Raw logs plus a ``hit`` struct: the first matching rule and its captures, all NULL for no match.

    Rules with one order number follow their other columns. Rules of devices travel as an ordered
    array per device. Rules for every device are indexed by text that their matches must contain, one
    rule a regex, and only rules whose text a log holds are tried; a base beyond the index's bounds is
    joined with the logs' texts by pieces of that text. ``compile_rows`` asks for literals in the plan
    instead, for at most so many rules. The result is the same.
    """
    rules = _rule_columns(rules, device_scoped)
    if not compile_rows:
        if device_scoped:
            return _array_match(logs, rules, device_scoped)
        rules = _first_rules(rules)
        few = collect_bounded(rules, INDEX_RULES)
        if few is not None and sum(len(r.regex) for r in few) <= INDEX_BYTES:
            return _indexed_match(logs, few)
        return _joined_match(logs, rules)
    return _compiled_match(logs, collect_to_compile(rules, compile_rows), device_scoped)


def _general_columns() -> dict[str, Column]:
    capture = {
        column: F.nullif(F.get(F.col("hit.captures"), F.lit(i)), F.lit(""))
        for i, column in enumerate(CAPTURES.values())}
    capture["source_port"] = F.translate(capture["source_port"], ":", "")
    capture["dest_port"] = F.translate(capture["dest_port"], ":", "")
    level = F.coalesce(blank_to_null(F.col("hit.event_level")), F.lit("1"))
    return {
        "record_id": stable_id("general", F.col("log_id")),
        "first_recv_time": F.col("recv_time"),
        "report_app": F.col("report_app"),
        "report_ip": F.col("report_ip"),
        "report_ne_type": F.col("hit.report_ne_type"),
        "event_def_id": F.translate(F.col("hit.event_def_id"), "-", ""),
        "event_level": level.try_cast("int"),
        "org_id": F.col("log_id").cast("string"),
        "event_id": F.col("hit.event_id"),
        "content": F.col("content"),
        "log_rule_id": F.col("hit.log_rule_id"),
        **capture,
    }


def normalize(
    logs: DataFrame, rules: DataFrame, device_scoped: bool = True, compile_rows: int = 0
) -> DataFrame:
    """General logs of the raw logs some rule matches."""
    matched = match_rules(logs, rules, device_scoped, compile_rows)
    return general_from_matches(matched, device_scoped)


def general_from_matches(matched: DataFrame, device_scoped: bool = True) -> DataFrame:
    columns = _general_columns()
    if device_scoped:
        names = GENERAL_FIELDS
    else:
        names = USER_GENERAL_FIELDS
        columns["first_recv_time"] = F.unix_millis("recv_time")
    return matched.where("hit.rule_ord is not null").select(*[columns[n].alias(n) for n in names])


def flag_matches(matched: DataFrame) -> DataFrame:
    """Raw logs with the stored match flag, which is 0 for matched and 1 for unmatched."""
    return matched.withColumn("is_match", F.when(F.col("hit.rule_ord").isNotNull(), 0).otherwise(1))


RULE_SCHEMA = T.StructType([
    T.StructField("rule_ord", T.IntegerType()),
    T.StructField("log_rule_id", T.StringType()),
    T.StructField("device_ip", T.StringType()),
    T.StructField("log_regex", T.StringType()),
    T.StructField("event_def_id", T.StringType()),
    T.StructField("event_level", T.StringType()),
    T.StructField("report_ne_type", T.StringType()),
    T.StructField("event_id", T.StringType()),
])
