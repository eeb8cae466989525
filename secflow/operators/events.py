"""General logs to single events."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.predicates import RULE_FIELDS, method_holds, rule_field_map, rule_field_text
from secflow.functions.text import stable_id
from secflow.plans.physical import broadcast_if_bounded, collect_to_compile, evaluated_once
from secflow.schemas import EVENT_FIELDS, EXT_FIELDS, GENERAL_FIELDS

# Fixed value: the reporting application of flow-derived events, stored with the user-defined origin.
FLOW_APP = "NE_FLOW"


def _event(
    logs: DataFrame, rule_id: Column, name: Column, level: Column, is_inner: Column,
    with_ext: bool, with_log: bool,
) -> DataFrame:
    columns = {
        "event_result_id": stable_id("event", F.col("record_id"), rule_id, is_inner),
        "event_rule_id": rule_id,
        "log_id": F.col("record_id"),
        "event_rule_name": name,
        "event_rule_level": level.cast("string"),
        "open_time": F.col("first_recv_time"),
        "action_opt": F.col("action_result"),
        "is_inner": is_inner,
        "proto": F.col("report_app"),
    }
    for c in EXT_FIELDS:
        columns[c] = F.col(c) if with_ext else F.lit(None).cast("string")
    out = [columns.get(n, F.col(n)).alias(n) for n in EVENT_FIELDS]
    if with_log:
        out.append(F.struct(*GENERAL_FIELDS).alias("log"))
    return logs.select(*out)


def _origin() -> Column:
    return F.when(F.col("report_app") == FLOW_APP, "0").otherwise("1")


def builtin_events(logs: DataFrame, defs: DataFrame, with_log: bool = False) -> DataFrame:
    """Events of logs whose name equals a built-in definition's value, trimmed and case-folded.

    Definitions are first reduced to one per name, the lowest in order, so the join keeps one row
    per log and needs no later de-duplication.
    """
    rule = F.struct("event_rule_id", "event_rule_name", "event_rule_level")
    first = (
        defs.groupBy(F.lower(F.trim("begin_value")).alias("rule_key"))
        .agg(F.min_by(rule, F.col("rule_ord").cast("long")).alias("rule")))
    # logs without a captured name carry one blank, which trims to ''
    key = F.lower(F.trim(F.coalesce("event_name", F.lit(""))))
    matched = logs.join(broadcast_if_bounded(first), key == F.col("rule_key"))
    return _event(
        matched, F.col("rule.event_rule_id"), F.col("rule.event_rule_name"),
        F.col("rule.event_rule_level"), _origin(), True, with_log)


def passthrough_events(logs: DataFrame, with_log: bool = False) -> DataFrame:
    """Every general log as an event under the event id its log rule carries."""
    return _event(
        logs, F.col("event_id"), F.col("event_name"), F.col("event_level"), _origin(), False, with_log)


def _definitions(defs: DataFrame, fields: DataFrame) -> DataFrame:
    """One row per definition in order, with its conditions as an array (empty when it has none)."""
    condition = F.struct(
        F.lower(F.trim("field")).alias("field"), F.col("method"),
        F.coalesce("begin_value", F.lit("")).alias("begin_value"),
        F.coalesce("end_value", F.lit("")).alias("end_value"))
    grouped = (
        fields.groupBy(F.trim("event_rule_id").alias("field_rule_id"))
        .agg(F.collect_list(condition).alias("conditions")))
    return defs.join(grouped, F.trim("event_rule_id") == F.col("field_rule_id"), "left").select(
        F.col("rule_ord").cast("long").alias("rule_ord"),
        F.col("event_rule_id"), F.col("event_rule_name"),
        F.col("event_rule_level").cast("string").alias("event_rule_level"),
        F.coalesce("conditions", F.array().cast(
            "array<struct<field:string,method:string,begin_value:string,end_value:string>>")).alias("conditions"))


def literal_condition(field: str | None, method, begin: str | None, end: str | None, strict: bool, prefix="") -> Column:
    """A rule condition as an expression over general-log columns, by field name in lower case; unknown fields never hold."""
    name = field or ""
    if name not in RULE_FIELDS:
        return F.lit(False)
    text = lambda v: F.lit("" if v is None else str(v))
    return method_holds(text(method), text(begin), text(end), rule_field_text(name, prefix), strict)


def user_events(
    logs: DataFrame, defs: DataFrame, fields: DataFrame, strict: bool = True,
    with_log: bool = False, compile_rows: int = 0,
) -> DataFrame:
    """Events of logs that satisfy all conditions of a user definition; the first in order wins.

    A definition without conditions matches everything. Definitions of one order number follow their
    id. They are evaluated as an array of rules; ``compile_rows`` asks for literals in the plan instead,
    for at most so many, with the same result.
    """
    rules = _definitions(defs, fields)
    if not compile_rows:
        ordered = rules.agg(F.array_sort(F.collect_list(F.struct(*rules.columns))).alias("rules"))
        holds = lambda c: F.coalesce(method_holds(
            c["method"], c["begin_value"], c["end_value"], F.col("values")[c["field"]], strict)
            & F.col("values")[c["field"]].isNotNull(), F.lit(False))
        logs = logs.withColumn("rules", ordered.scalar()).withColumn("values", rule_field_map())
        place = F.aggregate(
            F.sequence(F.lit(0), F.size("rules") - 1), F.lit(-1),
            lambda found, k: F.when(found >= 0, found).when(F.forall(F.get("rules", k)["conditions"], holds), k).otherwise(found))
        rule = F.get("rules", place)
        matched = evaluated_once(logs, "rule", rule)
    else:
        rows = sorted(collect_to_compile(rules, compile_rows), key=lambda r: (r.rule_ord, r.event_rule_id or ""))
        number = F.when(F.lit(False), F.lit(0))
        for n, r in enumerate(rows):
            test = F.lit(True)
            for c in r.conditions:
                test = test & literal_condition(c.field, c.method, c.begin_value, c.end_value, strict)
            number = number.when(test, F.lit(n))
        names = ("event_rule_id", "event_rule_name", "event_rule_level")
        table = json.dumps([{c: r[c] for c in names} for r in rows])
        constants = F.from_json(F.lit(table), "array<struct<" + ",".join(f"{c}:string" for c in names) + ">>")
        rule = F.get(constants, F.col("rule_no"))
        matched = evaluated_once(logs, "rule_no", number).where("rule_no is not null").withColumn("rule", rule)
    matched = matched.where("rule is not null")
    return _event(
        matched, F.col("rule.event_rule_id"), F.col("rule.event_rule_name"),
        F.col("rule.event_rule_level"), F.lit("0"), False, with_log)


def all_events(*feeds: DataFrame) -> DataFrame:
    """One feed of built-in and user events."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed)
    return first
