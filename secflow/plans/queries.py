"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.functions.text import name_tokens
from secflow.operators import alarms, assets, clusters, correlate, events, normalize, parse, profile, threshold
from secflow.plans.tables import (
    MONITORED_PREFIXES, MONITORED_RANGES, composite_rules, context, corr_events, frame)
from secflow.sources import readers, rules, sinks

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; instants leave without a zone, as the tables have them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = fn(spark, sf_dir)
        instants = [f.name for f in result.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return result.withColumns({n: F.col(n).cast("timestamp_ntz") for n in instants}) if instants else result

    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- logs ---------------------------------------------------------------------------------------


@query
def raw_parse(spark, sf_dir):
    return parse.raw_parse(parse.with_occurrence(frame(spark, sf_dir, "raw_line")), identity=F.col("source_id"))


def _general(spark, sf_dir):
    return normalize.normalize(frame(spark, sf_dir, "raw_log"), frame(spark, sf_dir, "log_rule"))


@query
def log_normalize(spark, sf_dir):
    return _general(spark, sf_dir)


@query
def log_match_flag(spark, sf_dir):
    matched = normalize.match_rules(frame(spark, sf_dir, "raw_log"), frame(spark, sf_dir, "log_rule"))
    return normalize.flag_matches(matched).select(
        "log_id", "report_ip", F.col("hit.log_rule_id").alias("log_rule_id"), "is_match")


@query
def log_normalize_user(spark, sf_dir):
    return normalize.normalize(
        frame(spark, sf_dir, "raw_log"), frame(spark, sf_dir, "user_log_rule"), device_scoped=False)


@query
def log_normalize_user_large(spark, sf_dir):
    """A rule base that grows with the data, for every device."""
    general = normalize.normalize(
        frame(spark, sf_dir, "raw_log"), frame(spark, sf_dir, "user_log_rule_large"), device_scoped=False)
    return general.select(
        "record_id", "log_rule_id", "event_def_id", "event_name", "source_ip", "source_port", "dest_port", "get_parameter")


@query
def event_name_tokens(spark, sf_dir):
    return frame(spark, sf_dir, "event_name").select(
        "p_partkey", name_tokens(F.col("event_name")).alias("event_name2"))


@query
def token_dedup(spark, sf_dir):
    return parse.token_dedup(frame(spark, sf_dir, "condition_text"))


@query
def log_query(spark, sf_dir):
    return readers.query_logs(
        frame(spark, sf_dir, "raw_log"),
        "select log_id, report_ip, report_app from {original_log} where severity = 'error' and report_app = 'NE_FLOW'")


# --- events -------------------------------------------------------------------------------------


def _builtin(spark, sf_dir):
    return events.builtin_events(_general(spark, sf_dir), frame(spark, sf_dir, "event_def"))


def _user(spark, sf_dir, strict=True):
    return events.user_events(
        _general(spark, sf_dir), frame(spark, sf_dir, "user_event_def"), frame(spark, sf_dir, "user_event_field"),
        strict)


@query
def event_builtin(spark, sf_dir):
    return _builtin(spark, sf_dir)


@query
def event_user_fields(spark, sf_dir):
    return _user(spark, sf_dir)


@query
def event_user_fields_full(spark, sf_dir):
    return _user(spark, sf_dir, strict=False).select("event_result_id", "event_rule_id", "log_id")


@query
def event_passthrough(spark, sf_dir):
    return events.passthrough_events(_general(spark, sf_dir))


@query
def event_all(spark, sf_dir):
    return events.all_events(_builtin(spark, sf_dir), _user(spark, sf_dir))


# --- alarms -------------------------------------------------------------------------------------


def _policies(spark, sf_dir):
    return frame(spark, sf_dir, "policy_whole"), frame(spark, sf_dir, "policy_event")


@query
def alarm_single(spark, sf_dir):
    return alarms.alarms(alarms.from_events(_builtin(spark, sf_dir)), *_policies(spark, sf_dir))


@query
def alarm_windowed(spark, sf_dir):
    return alarms.alarms(alarms.from_events(_builtin(spark, sf_dir)), *_policies(spark, sf_dir), mode="windowed")


@query
def alarm_windowed_reset(spark, sf_dir):
    return alarms.alarms(
        alarms.from_events(_builtin(spark, sf_dir)), *_policies(spark, sf_dir), mode="windowed_reset")


@query
def alarm_composite(spark, sf_dir):
    composites = correlate.composite_rows(_composites(spark, sf_dir))
    return alarms.alarms(
        alarms.from_composites(composites), frame(spark, sf_dir, "policy_whole"),
        frame(spark, sf_dir, "policy_composite"), alarms.COMPOSITE)


# --- correlation --------------------------------------------------------------------------------


@query
def corr_detail_hits(spark, sf_dir):
    return correlate.detail_hits(corr_events(spark, sf_dir), composite_rules(spark, sf_dir))


@query
def corr_threshold(spark, sf_dir):
    hits = correlate.detail_hits(corr_events(spark, sf_dir), composite_rules(spark, sf_dir))
    return correlate.detail_fires(hits)


@query
def corr_members(spark, sf_dir):
    events_ = corr_events(spark, sf_dir)
    hits = correlate.detail_hits(events_, composite_rules(spark, sf_dir))
    return correlate.detail_members(hits, events_).select(
        "detail_id", "bucket", "event_result_id", "event_rule_name", "source_ip", "dest_ip", "dest_port")


@query
def corr_leak_match(spark, sf_dir):
    flagged = correlate.leak_flags(frame(spark, sf_dir, "corr_event"), frame(spark, sf_dir, "leak_scan"))
    return correlate.leak_matches(flagged, frame(spark, sf_dir, "me_leak"))


@query
def corr_intel_match(spark, sf_dir):
    flagged = correlate.intel_flag(frame(spark, sf_dir, "corr_event"), frame(spark, sf_dir, "intel"))
    return correlate.intel_matches(flagged, frame(spark, sf_dir, "me_intel"))


@query
def corr_asset_match(spark, sf_dir):
    return correlate.asset_matches(
        frame(spark, sf_dir, "corr_event"), frame(spark, sf_dir, "asset_rule"),
        frame(spark, sf_dir, "asset"), frame(spark, sf_dir, "asset_ip"))


@query
def corr_condition_exp(spark, sf_dir):
    return correlate.condition_match(frame(spark, sf_dir, "corr_event"), frame(spark, sf_dir, "me_flow"))


@query
def corr_flow_asof(spark, sf_dir):
    seen = correlate.flow_asof(frame(spark, sf_dir, "corr_event"), frame(spark, sf_dir, "flow_stat"))
    return correlate.flow_matches(seen, frame(spark, sf_dir, "me_flow"))


def _floors(spark, sf_dir):
    return correlate.definition_floors(
        corr_events(spark, sf_dir), composite_rules(spark, sf_dir), context(spark, sf_dir))


def _composites(spark, sf_dir):
    return correlate.composite_events(_floors(spark, sf_dir))


@query
def corr_fold(spark, sf_dir):
    return _floors(spark, sf_dir).select("def_id", "event_result_id", "pos", "floor")


@query
def corr_composite(spark, sf_dir):
    return correlate.composite_rows(_composites(spark, sf_dir))


@query
def corr_composite_members(spark, sf_dir):
    return correlate.composite_members(_composites(spark, sf_dir))


# --- flows and assets ---------------------------------------------------------------------------


@query
def flow_json_explode(spark, sf_dir):
    return parse.flow_fields(
        parse.flow_json_explode(parse.with_occurrence(frame(spark, sf_dir, "flow_message")), identity=F.col("source_id")),
        "srcip", "dstip", "bytes", "recordid")


@query
def appflow_line_parse(spark, sf_dir):
    return parse.flow_fields(
        parse.appflow_line_parse(parse.with_occurrence(frame(spark, sf_dir, "app_flow_line")), identity=F.col("source_id")),
        "srcip", "dstip", "appproto", "method")


@query
def ip_range_filter(spark, sf_dir):
    return assets.in_ranges(frame(spark, sf_dir, "netflow"), "srcip", MONITORED_RANGES).select(
        "srcip", F.col("ip_number").alias("src_number"), "dstip", "srcport", "start_time")


@query
def ip_range_table(spark, sf_dir):
    return assets.in_range_table(
        frame(spark, sf_dir, "netflow"), "srcip", frame(spark, sf_dir, "monitored_range")).select(
        "srcip", F.col("ip_number").alias("src_number"), "dstip", "srcport", "start_time")


@query
def netflow_range(spark, sf_dir):
    flows = readers.in_time_range(
        frame(spark, sf_dir, "netflow"), "1997-01-01 00:00:00", "1998-01-01 00:00:00")
    return readers.complete_netflow(flows).select("srcip", "dstip", "proto", "packets", "bytes", "record_time")


@query
def asset_discovery(spark, sf_dir):
    return assets.discover_assets(frame(spark, sf_dir, "netflow"), frame(spark, sf_dir, "registered"), MONITORED_RANGES)


@query
def asset_flow_profile(spark, sf_dir):
    return profile.flow_profile(frame(spark, sf_dir, "netflow"), MONITORED_PREFIXES)


@query
def asset_app_profile(spark, sf_dir):
    return profile.app_profile(frame(spark, sf_dir, "app_flow"), MONITORED_PREFIXES)


@query
def asset_subcluster_features(spark, sf_dir):
    return profile.subcluster_features(frame(spark, sf_dir, "app_flow"), frame(spark, sf_dir, "flow_cluster"))


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query
def asset_minmax(spark, sf_dir):
    names = profile.FLOW_FEATURES
    scaled = profile.min_max_normalize(profile.flow_profile(frame(spark, sf_dir, "netflow"), MONITORED_PREFIXES), names)
    return _rounded(scaled, [n + "_nor" for n in names]).select("ip", *[n + "_nor" for n in names])


@query
def flow_features(spark, sf_dir):
    return profile.flow_features(frame(spark, sf_dir, "netflow"))


@query
def flow_standardize(spark, sf_dir):
    names = profile.FEATURE_COLUMNS
    scaled = profile.standardize(profile.flow_features(frame(spark, sf_dir, "netflow")), names)
    return _rounded(scaled, [n + "_scl" for n in names]).select("dstip", "record_time", *[n + "_scl" for n in names])


@query
def flow_index_lookup(spark, sf_dir):
    return profile.lookup_by_index(
        frame(spark, sf_dir, "flow_index"), frame(spark, sf_dir, "keyed_flow"), "rowkey",
        "1996-01-01 00:00:00", "1996-12-31 00:00:00")


def _clustered(spark, sf_dir):
    """Profiles with a cluster label taken from the address, and the mean of each cluster."""
    octet = F.substring_index("ip", ".", -1).cast("int")
    points = profile.flow_profile(frame(spark, sf_dir, "netflow"), MONITORED_PREFIXES).withColumn("cluster", octet % 3)
    return points, points.groupBy("cluster").agg(*[F.avg(n).alias(n) for n in profile.FLOW_FEATURES])


@query
def asset_distance(spark, sf_dir):
    points, centres = _clustered(spark, sf_dir)
    far = profile.centre_distance(points, centres, profile.FLOW_FEATURES)
    return _rounded(far, ["distance"]).select(
        "ip", "cluster", "distance",
        F.concat_ws("#", *[F.col(n).cast("string") for n in profile.FLOW_FEATURES]).alias("center_info"))


@query
def asset_cluster_sizes(spark, sf_dir):
    return profile.cluster_sizes(_clustered(spark, sf_dir)[0])


def _profiles(spark, sf_dir):
    return profile.flow_profile(frame(spark, sf_dir, "netflow"), MONITORED_PREFIXES)


def _app_groups(spark, sf_dir):
    return frame(spark, sf_dir, "app_flow"), frame(spark, sf_dir, "flow_cluster")


@query
def asset_kmeans(spark, sf_dir):
    return _rounded(clusters.first_level(_profiles(spark, sf_dir)), ["distance"]).select("ip", "cluster", "distance")


@query
def asset_kmeans_l2(spark, sf_dir):
    """The count is chosen for each first-level cluster among several."""
    level = clusters.second_level(*_app_groups(spark, sf_dir), candidates=(2, 3, 5))
    return _rounded(level, ["distance"]).select("parent", "ip", "k", "cluster", "distance")


@query
def asset_silhouette(spark, sf_dir):
    return _rounded(clusters.silhouette_table(_profiles(spark, sf_dir), range(3, 6)), ["silhouette", "cost"])


@query
def stored_cluster_point(spark, sf_dir):
    rows = clusters.point_rows(
        clusters.first_level(_profiles(spark, sf_dir)), profile.FLOW_FEATURES, "batch-1", "2024-01-01 00:00:00")
    return _rounded(rows, ["distance"])


@query
def stored_cluster_centre(spark, sf_dir):
    """Centres of both levels; their numbers are compared as millionths."""
    stamp = "2024-01-01 00:00:00"
    first = clusters.centre_docs(
        clusters.first_level_centres(_profiles(spark, sf_dir)), profile.FLOW_FEATURES, "batch-1", stamp, 1)
    second = clusters.centre_docs(
        clusters.second_level_centres(*_app_groups(spark, sf_dir), candidates=(2, 3, 5)), profile.APP_FEATURES,
        "batch-2", stamp, 2, "batch-1")
    millionths = F.transform(
        F.split("center_info", "#"), lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string"))
    return first.unionByName(second).withColumn("center_info", F.array_join(millionths, "#"))


# --- rules --------------------------------------------------------------------------------------


@query
def rules_log_regex(spark, sf_dir):
    f = lambda n: frame(spark, sf_dir, n)
    return rules.log_regex_by_device(f("store_regex"), f("store_lib"), f("store_asset"), f("store_asset_ip"))


@query
def rules_event_builtin(spark, sf_dir):
    return rules.builtin_event_rules(
        frame(spark, sf_dir, "store_event_def"), frame(spark, sf_dir, "store_event_field"))


@query
def rules_snapshot(spark, sf_dir):
    policy = rules.select_rules(frame(spark, sf_dir, "store_policy"), "policy_whole")
    sub = rules.select_rules(frame(spark, sf_dir, "store_sub"), "composite_sub")
    return rules.snapshot_docs(policy, "policy_whole").unionByName(rules.snapshot_docs(sub, "composite_sub"))


# --- stored forms -------------------------------------------------------------------------------


@query
def stored_raw_log(spark, sf_dir):
    return sinks.raw_log_docs(frame(spark, sf_dir, "raw_line"))


@query
def stored_general_log(spark, sf_dir):
    return sinks.general_log_docs(_general(spark, sf_dir))


@query
def stored_event(spark, sf_dir):
    return sinks.event_docs(_builtin(spark, sf_dir))


@query
def stored_alarm(spark, sf_dir):
    return sinks.alarm_docs(
        alarms.alarms(alarms.from_events(_builtin(spark, sf_dir)), *_policies(spark, sf_dir)))


@query
def stored_composite(spark, sf_dir):
    return sinks.composite_docs(correlate.composite_rows(_composites(spark, sf_dir)))


@query
def stored_composite_member(spark, sf_dir):
    return sinks.member_docs(correlate.composite_members(_composites(spark, sf_dir)))


@query
def threshold_totals(spark, sf_dir):
    """Hits, fires and left-over hits of each policy counter."""
    hits = alarms.policy_hits(alarms.from_events(_builtin(spark, sf_dir)), *_policies(spark, sf_dir))
    numbered = threshold.running(hits, ["policy_id"], ["ts", "event_id"])
    return numbered.groupBy("policy_id", "n").agg(
        F.max("rn").alias("hits"), F.sum(F.when(F.col("rn") % F.col("n") == 0, 1).otherwise(0)).alias("fires"))
