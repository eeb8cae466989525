"""Policy alarms over single and composite events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import format_time, stable_id
from secflow.operators.threshold import threshold_fire
from secflow.plans.physical import broadcast_if_bounded


@dataclass(frozen=True)
class AlarmKind:
    """Fixed values of an alarm source: policy kind, rule column and alarm text."""

    obj_table: str
    rule_column: str
    prefix: str
    suffix: str = "】发生告警!"


SINGLE = AlarmKind("t_siem_alarm_policy_event", "event_rule_id", "事件【")
COMPOSITE = AlarmKind("t_siem_alarm_policy_relation_ev", "relation_event_rule_id", "联合事件【")


def policies(whole: DataFrame, detail: DataFrame, kind: AlarmKind) -> DataFrame:
    """Policies of one kind, one row per watched rule id."""
    active = whole.where(F.lower("obj_table") == kind.obj_table).select(
        F.col("record_id").alias("obj_id"), F.col("alarm_level"),
        F.col("start_time").try_cast("timestamp").alias("valid_from"),
        F.col("end_time").try_cast("timestamp").alias("valid_to"))
    watched = detail.select(
        F.col("record_id").alias("policy_id"), F.lower(F.trim("alarm_id")).alias("alarm_key"),
        F.lower(F.trim(kind.rule_column)).alias("rule_key"),
        F.col("count").cast("long").alias("n"), F.col("control_time").cast("long").alias("seconds"))
    return watched.join(active, F.col("alarm_key") == F.lower(F.trim("obj_id"))).drop("alarm_key")


def policy_hits(
    events: DataFrame, whole: DataFrame, detail: DataFrame, kind: AlarmKind = SINGLE, check_validity: bool = False
) -> DataFrame:
    """One row per (event, watching policy). ``events`` carry rule_id, event_id, name and ts."""
    rules = broadcast_if_bounded(policies(whole, detail, kind))
    hits = events.join(rules, F.lower(F.trim("rule_id")) == F.col("rule_key"))
    if check_validity:
        hits = hits.where(
            (F.col("valid_from").isNull() | (F.col("ts") >= F.col("valid_from")))
            & (F.col("valid_to").isNull() | (F.col("ts") <= F.col("valid_to"))))
    return hits.select("policy_id", "obj_id", "alarm_level", "n", "seconds", "ts", "event_id", "name")


def alarm_rows(fires: DataFrame, kind: AlarmKind = SINGLE) -> DataFrame:
    """Alarm records of fired hits."""
    time = format_time(F.col("ts"))
    content = F.concat(time, F.lit(kind.prefix), F.coalesce("name", F.lit("")), F.lit(kind.suffix))
    return fires.select(
        stable_id("alarm", F.col("policy_id"), F.col("event_id")).alias("record_id"),
        F.col("ts").alias("first_alarm_time"), content.alias("content"),
        F.lit(kind.obj_table).alias("obj_table"), F.col("obj_id"), F.lit(1).alias("alarm_times"),
        "policy_id", "event_id")


def alarms(
    events: DataFrame, whole: DataFrame, detail: DataFrame, kind: AlarmKind = SINGLE,
    mode: str = "cumulative", check_validity: bool = False,
) -> DataFrame:
    """Alarms of policies whose event count is reached; policies count independently of each other."""
    hits = policy_hits(events, whole, detail, kind, check_validity)
    return alarm_rows(threshold_fire(hits, "policy_id", "ts", "event_id", mode=mode), kind)


def from_events(events: DataFrame) -> DataFrame:
    """Single events in the shape policies read."""
    return events.select(
        F.col("event_rule_id").alias("rule_id"), F.col("event_result_id").alias("event_id"),
        F.col("event_rule_name").alias("name"), F.col("open_time").alias("ts"))


def from_composites(composites: DataFrame) -> DataFrame:
    """Composite events in the shape policies read."""
    return composites.select(
        F.col("me_def_id").alias("rule_id"), F.col("record_id").alias("event_id"),
        F.col("name"), F.col("storage_time").alias("ts"))
