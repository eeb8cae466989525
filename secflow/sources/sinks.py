"""Stored forms of each record, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import epoch_millis, name_tokens, split_fields, stable_id
from secflow.schemas import EXT_FIELDS, GENERAL_FIELDS


def raw_log_docs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw lines with their match flag: at least eight fields; a blank flag is 1, a malformed one 0."""
    fields = split_fields(F.col(value), "~", 9)
    item = lambda i: F.get("f", F.lit(i))
    time = epoch_millis(F.try_to_timestamp(F.trim(item(1)), F.lit("yyyy-MM-dd HH:mm:ss")))
    flag = F.when(F.trim(item(7)) == "", F.lit(1)).otherwise(
        F.coalesce(F.trim(item(7)).try_cast("int"), F.lit(0)))
    kept = lines.where(F.contains(F.col(value), F.lit("~"))).select(fields.alias("f")).where(F.size("f") >= 8)
    return kept.select(
        stable_id("raw", item(0)).alias("row"), item(0).alias("recordid"), time.alias("recvtime"),
        time.alias("storagetime"), item(2).alias("reportip"), item(5).alias("reportapp"),
        item(6).alias("logcontent"), flag.alias("ismatch"))


# Field names of stored logs -> columns.
_GENERAL_DOC = {
    "recordid": "record_id", "reportapp": "report_app", "reportip": "report_ip", "sourceip": "source_ip",
    "sourceport": "source_port", "destip": "dest_ip", "destport": "dest_port", "eventaction": "event_action",
    "actionresult": "action_result", "reportnetype": "report_ne_type", "eventdefid": "event_def_id",
    "eventname": "event_name", "eventlevel": "event_level", "orgid": "org_id", "appproto": "app_proto",
    "url": "url", "getparameter": "get_parameter", "orglog": "content", "logruleid": "log_rule_id",
}


def general_log_docs(logs: DataFrame, user: bool = False) -> DataFrame:
    """General logs as stored: epoch milliseconds and the tokenised event name for substring search.

    User logs already carry milliseconds and have no extension fields.
    """
    time = F.col("first_recv_time") if user else epoch_millis(F.col("first_recv_time"))
    tokens = F.coalesce(name_tokens(F.col("event_name")), F.lit(""))
    extension = [] if user else EXT_FIELDS
    return logs.select(
        stable_id("row", F.col("record_id")).alias("row"), time.alias("firstrecvtime"),
        *[F.col(c).alias(n) for n, c in _GENERAL_DOC.items()], tokens.alias("eventname2"), *extension)


# Field names of stored events -> columns.
_EVENT_DOC = {
    "event_rule_result_id": "event_result_id", "logid": "log_id", "event_rule_name": "event_rule_name",
    "event_rule_level": "event_rule_level", "reportneip": "report_ip", "sourceip": "source_ip",
    "sourceport": "source_port", "destip": "dest_ip", "destport": "dest_port", "actionopt": "action_opt",
    "is_inner": "is_inner", "proto": "proto",
}


def event_docs(events: DataFrame) -> DataFrame:
    """Events as stored: rule ids trimmed and in lower case, time in epoch milliseconds."""
    return events.select(
        stable_id("row", F.col("event_result_id")).alias("row"),
        F.lower(F.trim("event_rule_id")).alias("event_rule_id"), epoch_millis(F.col("open_time")).alias("opentime"),
        *[F.col(c).alias(n) for n, c in _EVENT_DOC.items()], *EXT_FIELDS)


def composite_docs(composites: DataFrame) -> DataFrame:
    return composites.select(
        stable_id("row", F.col("record_id")).alias("row"), F.col("record_id").alias("recordid"),
        F.col("me_def_id").alias("medid"), epoch_millis(F.col("storage_time")).alias("storagetime"))


def member_docs(members: DataFrame) -> DataFrame:
    return members.select(
        stable_id("row", F.col("composite_id")).alias("row"), F.col("record_id").alias("recordid"),
        F.col("event_result_id").alias("event_rule_result_id"), F.col("composite_id").alias("t_s_recordid"))


def alarm_docs(alarms: DataFrame) -> DataFrame:
    return alarms.select(
        stable_id("row", F.col("record_id")).alias("row"), F.col("record_id").alias("recordid"),
        epoch_millis(F.col("first_alarm_time")).alias("firstalarmtime"), F.col("content").alias("alarmcontent"),
        F.col("obj_table").alias("objtable"), F.col("obj_id").alias("objid"),
        F.col("alarm_times").alias("alarmtimes"))


def general_log_lines(logs: DataFrame) -> DataFrame:
    """General logs as ``~``-joined text; missing values are one blank."""
    columns: list[Column] = [F.col("record_id")]
    for n in GENERAL_FIELDS:
        c = F.date_format(n, "yyyy-MM-dd HH:mm:ss") if n == "first_recv_time" else F.col(n).cast("string")
        columns.append(F.coalesce(c, F.lit(" ")))
    return logs.select(F.concat_ws("~", *columns).alias("value"))


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch, overwritten when the batch is replayed."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_topics(df: DataFrame, servers: str, topics: list[str]) -> None:
    """Rows as JSON to one or more topics. Needs the Kafka connector on the class path."""
    names = F.explode(F.array(*[F.lit(t) for t in topics]))
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).select("value", names.alias("topic")).write.format(
        "kafka").option("kafka.bootstrap.servers", servers).save()
