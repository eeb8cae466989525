"""Rule tables: reads with pushed-down predicates, the two joined rule sets, and snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.operators.threshold import running


@dataclass(frozen=True)
class RuleSet:
    table: str
    columns: tuple[str, ...]
    where: str | None = None
    order: tuple[str, ...] = ()


# What each single-table rule read returns. Names are those of the rule store.
RULE_SETS = {
    "policy_whole": RuleSet(
        "t_siem_alarm_policy_whole",
        ("recordid", "alarm_name", "start_time", "end_time", "alarm_level", "alert_type", "objtable", "objid",
         "alarm_comment", "status"), "status = 1"),
    "policy_event": RuleSet(
        "t_siem_alarm_policy_event", ("recordid", "alarm_id", "event_rule_id", "control_time", "count")),
    "policy_relation": RuleSet(
        "t_siem_alarm_policy_relation_ev",
        ("recordid", "alarm_id", "relation_event_rule_id", "control_time", "count")),
    "leak_scan": RuleSet(
        "t_siem_leakscan",
        ("recordid", "neid", "neip", "leak_name", "leak_port", "leak_level", "leak_type", "leak_cve", "leak_sid",
         "leak_flag")),
    "event_def_user": RuleSet(
        "t_siem_event_rule_def",
        ("event_rule_id", "event_rule_lib_id", "event_rule_code", "event_rule_name", "event_rule_level",
         "event_basic_type", "event_sub_type", "event_rule_desc", "event_rule", "is_inner", "is_use"),
        "is_inner = 0 and is_use = 1"),
    "event_field": RuleSet(
        "t_siem_event_rule_field",
        ("event_rule_field_id", "event_rule_id", "event_rule_field", "match_method", "filed_begin_value",
         "filed_end_value")),
    "log_regex_user": RuleSet(
        "t_siem_log_regex",
        ("log_rule_id", "log_rule_lib_id", "log_rule_code", "log_regex", "eventdefid", "eventlevel",
         "reportnetype", "eventid"), "is_inner = '0'"),
    "composite_def": RuleSet(
        "t_siem_medefine",
        ("recordid", "multieventname", "eventdesc", "multieventtype", "eventlevel", "status", "advice"),
        "status = 1"),
    "composite_sub": RuleSet(
        "t_siem_medefine_sub", ("recordid", "medefineid", "op", "objtable", "status"), "status = 1",
        ("objtable",)),
    "detail": RuleSet(
        "t_siem_medetail",
        ("recordid", "medid", "eventid", "timelimit", "times", "op", "flag", "fieldname", "fieldop", "fieldvalue")),
    "detail_leak": RuleSet("t_siem_medetail3", ("recordid", "medid", "cvematch", "leakmatch", "portmatch")),
    "detail_flow": RuleSet(
        "t_siem_medetail6",
        ("recordid", "medid", "begintime", "endtime", "statisperiod", "flowlimit", "diologlimit", "conditionexp")),
    "detail_asset": RuleSet("t_siem_medetail5", ("recordid", "medid", "iptype", "ipaddr", "os")),
    "detail_intel": RuleSet("t_siem_medetail4", ("recordid", "medid", "ipmatch")),
    "asset_ip": RuleSet("t_moni_device_ip", ("device_ip",)),
}

# Rule-store names -> names the operators use.
OPERATOR_NAMES = {
    "recordid": "record_id", "objtable": "obj_table", "objid": "obj_id", "neid": "ne_id", "neip": "ne_ip",
    "event_rule_field": "field", "match_method": "method", "filed_begin_value": "begin_value",
    "filed_end_value": "end_value", "eventdefid": "event_def_id", "reportnetype": "report_ne_type",
    "eventid": "event_id", "medefineid": "me_define_id", "medid": "med_id",
    "timelimit": "time_limit", "fieldname": "field_name", "fieldop": "field_op", "fieldvalue": "field_value",
    "cvematch": "cve_match", "leakmatch": "leak_match", "portmatch": "port_match",
    "statisperiod": "statis_period", "flowlimit": "flow_limit", "diologlimit": "diolog_limit",
    "conditionexp": "condition_exp", "iptype": "ip_type", "ipaddr": "ip_addr", "ipmatch": "ip_match",
    "multieventname": "name", "eventlevel": "event_level",
}


def select_rules(table: DataFrame, name: str) -> DataFrame:
    """One rule set from its table; the predicate reaches the scan."""
    spec = RULE_SETS[name]
    rows = table.where(spec.where) if spec.where else table
    rows = rows.select(*spec.columns)
    return rows.orderBy(*spec.order) if spec.order else rows


def load_rules(spark: SparkSession, name: str, jdbc: dict | None = None, folder: str | None = None) -> DataFrame:
    """A rule set from a JDBC store (``jdbc`` holds url, user, ...) or from Parquet tables in ``folder``."""
    spec = RULE_SETS[name]
    if jdbc is not None:
        return select_rules(spark.read.format("jdbc").options(dbtable=spec.table, **jdbc).load(), name)
    return select_rules(spark.read.parquet(f"{folder}/{spec.table}"), name)


def operator_columns(rules: DataFrame) -> DataFrame:
    """Rule columns under the names operators use."""
    return rules.withColumnsRenamed({k: v for k, v in OPERATOR_NAMES.items() if k in rules.columns})


def log_regex_by_device(regexes: DataFrame, libs: DataFrame, assets: DataFrame, asset_ips: DataFrame) -> DataFrame:
    """Regex rules of each device address: asset -> library of its type, vendor and model -> rules."""
    ips = asset_ips.select(F.col("ne_id").alias("ip_ne_id"), "device_ip")
    devices = assets.join(ips, F.col("ne_id") == F.col("ip_ne_id"), "left").select(
        "htype_id", "vendor_id", "model", "device_ip")
    lib_devices = libs.join(devices, ["htype_id", "vendor_id", "model"]).select(
        F.col("log_rule_lib_id").alias("device_lib_id"), "device_ip")
    joined = regexes.join(lib_devices, F.col("log_rule_lib_id") == F.col("device_lib_id"), "right")
    return joined.where("device_ip is not null and log_rule_id is not null").drop("device_lib_id")


def builtin_event_rules(defs: DataFrame, fields: DataFrame) -> DataFrame:
    """Built-in definitions in use with their fields; definitions without fields do not appear."""
    right = fields.select(F.col("event_rule_id").alias("field_rule_id"), "begin_value", "field", "method")
    joined = defs.join(right, F.col("event_rule_id") == F.col("field_rule_id"), "right")
    return joined.where("is_inner = 1 and is_use = 1").drop("field_rule_id", "is_inner", "is_use")


# Store tables behind the joined rule sets.
STORE_TABLES = {
    "regex": "t_siem_log_regex", "lib": "t_siem_log_regex_lib", "asset": "t_siem_moni_ne", "asset_ip": "t_moni_device_ip",
    "event_def": "t_siem_event_rule_def", "event_field": "t_siem_event_rule_field"}

#: Names under which operators and stages ask for rule sets; the two joined sets have loaders of their own.
OPERATOR_TABLES = {
    "policy_whole": "policy_whole", "policy_event": "policy_event", "policy_composite": "policy_relation",
    "leak_scan": "leak_scan", "user_event_def": "event_def_user", "user_event_field": "event_field",
    "user_log_rule": "log_regex_user", "me_define": "composite_def", "me_sub": "composite_sub", "me_detail": "detail",
    "me_leak": "detail_leak", "me_flow": "detail_flow", "me_asset": "detail_asset", "me_intel": "detail_intel",
    "monitored_ip": "asset_ip"}

# Columns whose order decides between rules that would all match; a store has no order of its own.
_ORDERED = {
    "log_rule": ["device_ip", "log_rule_id", "log_rule_lib_id", "log_regex"],
    "event_def": ["event_rule_id", "begin_value"], "user_event_def": ["event_rule_id"],
    "user_log_rule": ["log_rule_id", "log_rule_lib_id", "log_regex"]}

# Columns that operators compute with; snapshots hold text, and what is no number becomes NULL.
_NUMBERS = {
    "int": ["status", "op", "flag", "cve_match", "leak_match", "port_match", "ip_match", "ip_type", "os", "statis_period"],
    "bigint": ["rule_ord", "count", "control_time", "times", "time_limit", "flow_limit"]}


def ordered_rules(rules: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``rule_ord``, the place of a rule by ``columns`` (text, nulls first), from a range sort."""
    keys = {f"_by_{k}": F.col(c).cast("string") for k, c in enumerate(columns)}
    return running(rules.withColumns(keys), [], list(keys), "rule_ord").drop(*keys)


def load_store_table(spark: SparkSession, name: str, jdbc: dict | None = None, folder: str | None = None) -> DataFrame:
    """A whole table of the rule store, with column names in lower case."""
    if jdbc is not None:
        rows = spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    else:
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows.toDF(*[c.lower() for c in rows.columns])


def load_log_regex(spark: SparkSession, jdbc: dict | None = None, folder: str | None = None) -> DataFrame:
    """Regex rules of each device address from their four tables, under operators' names."""
    names = {"htypeid": "htype_id", "hteyid": "htype_id", "htyeid": "htype_id", "vendorid": "vendor_id"}
    part = lambda n: load_store_table(spark, STORE_TABLES[n], jdbc, folder)
    renamed = lambda t: t.withColumnsRenamed({k: v for k, v in names.items() if k in t.columns})
    return operator_columns(
        log_regex_by_device(part("regex"), renamed(part("lib")), renamed(part("asset")), part("asset_ip")))


def load_builtin_events(spark: SparkSession, jdbc: dict | None = None, folder: str | None = None) -> DataFrame:
    """Built-in event definitions in use with their fields, under operators' names."""
    part = lambda n: load_store_table(spark, STORE_TABLES[n], jdbc, folder)
    return builtin_event_rules(part("event_def"), operator_columns(part("event_field")))


def load_operator_tables(spark: SparkSession, jdbc: dict | None = None, folder: str | None = None) -> dict[str, DataFrame]:
    """All seventeen rule sets of a store in the form operators read, with ``rule_ord`` where the first rule wins."""
    tables = {
        name: operator_columns(load_rules(spark, rule_set, jdbc, folder)) for name, rule_set in OPERATOR_TABLES.items()}
    tables["log_rule"] = load_log_regex(spark, jdbc, folder)
    tables["event_def"] = load_builtin_events(spark, jdbc, folder)
    for name, columns in _ORDERED.items():
        tables[name] = ordered_rules(tables[name], columns)
    return tables


def sync_rules(spark: SparkSession, snapshots: str, version: int, jdbc: dict | None = None, store: str | None = None) -> None:
    """Copy a rule store into the next snapshot, from which stages read."""
    write_snapshot(load_operator_tables(spark, jdbc, store), snapshots, version)


def operator_types(rules: DataFrame) -> DataFrame:
    """Text of a snapshot as the types operators compute with."""
    casts = {
        c: F.col(c).try_cast(kind) for kind, names in _NUMBERS.items() for c in names
        if c in rules.columns and dict(rules.dtypes)[c] == "string"}
    return rules.withColumns(casts) if casts else rules


def snapshot_docs(rules: DataFrame, name: str) -> DataFrame:
    """Each rule as a JSON object of strings; NULL becomes the empty string."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c.lower()) for c in rules.columns]
    return rules.select(F.lit(name).alias("rule_set"), F.to_json(F.struct(*texts)).alias("doc"))


def write_snapshot(rules: dict[str, DataFrame], folder: str, version: int) -> None:
    """One versioned snapshot of all rule sets. A reader picks a version only once it is complete."""
    for name, frame in rules.items():
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c.lower()) for c in frame.columns]
        frame.select(*texts).write.mode("overwrite").parquet(f"{folder}/version={version}/{name}")
    spark = next(iter(rules.values())).sparkSession
    done = spark.createDataFrame([(version,)], "snapshot long")
    done.coalesce(1).write.mode("append").parquet(f"{folder}/complete")


def latest_version(spark: SparkSession, folder: str) -> int:
    return spark.read.schema("snapshot long").parquet(f"{folder}/complete").agg(F.max("snapshot")).first()[0]


def read_snapshot(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    version = latest_version(spark, folder) if version is None else version
    return spark.read.parquet(f"{folder}/version={version}/{name}")


def rules_from_json(docs: DataFrame, columns: list[str], doc: str = "doc") -> DataFrame:
    """Rule rows back from JSON objects, all values text."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return docs.select(F.from_json(doc, schema).alias("r")).select("r.*")
