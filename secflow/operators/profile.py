"""Per-address traffic features and their scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.text import epoch_millis, euclidean, ip_prefix
from secflow.plans.physical import broadcast_if_bounded

# Protocol -> code.
PROTO_CODES = {"TCP": 1, "UDP": 2, "ICMP": 3, "GRE": 4}
# Feature names of the first and second clustering level, in stored order.
FLOW_FEATURES = ["TCP", "ICMP", "GRE", "UDP", "time", "packernum", "bytesize"]
APP_FEATURES = ["QQ", "FTP", "HTTP", "TELNET", "DBAudit", "bd_local_trojan", "GET", "POST"]
APP_PROTOCOLS = ["QQ", "FTP", "HTTP", "TELNET", "DBAudit", "bd-local-trojan"]
METHODS = ["GET", "POST"]
MIN_GROUP = 3  # groups must be larger than this to be clustered again


def duration_ms() -> Column:
    return epoch_millis(F.col("end_time")) - epoch_millis(F.col("start_time"))


def monitored_end(prefixes: list[str]) -> Column:
    """The monitored address of a flow, source preferred; NULL when neither end is monitored."""
    return (
        F.when(ip_prefix(F.col("srcip")).isin(prefixes), F.col("srcip"))
        .when(ip_prefix(F.col("dstip")).isin(prefixes), F.col("dstip")))


def flow_profile(flows: DataFrame, prefixes: list[str]) -> DataFrame:
    """Duration, packets, bytes and flows per protocol of each monitored address."""
    rows = flows.select(
        monitored_end(prefixes).alias("ip"), duration_ms().alias("ms"), "packets", "bytes", "proto"
    ).where("ip is not null")
    return rows.groupBy("ip").agg(
        F.sum("ms").alias("time"), F.sum("packets").alias("packernum"), F.sum("bytes").alias("bytesize"),
        *[F.count(F.when(F.col("proto") == p, 1)).alias(p) for p in ("TCP", "ICMP", "GRE", "UDP")])


def _app_counts() -> list[Column]:
    protocols = [
        F.count(F.when(F.col("appproto") == p, 1)).alias(p.replace("-", "_")) for p in APP_PROTOCOLS]
    return protocols + [F.count(F.when(F.col("method") == m, 1)).alias(m) for m in METHODS]


def app_profile(flows: DataFrame, prefixes: list[str]) -> DataFrame:
    """Flows per application protocol and method of each monitored address."""
    rows = flows.select(monitored_end(prefixes).alias("ip"), "appproto", "method").where("ip is not null")
    return rows.groupBy("ip").agg(*_app_counts())


def cluster_sizes(members: DataFrame, cluster: str = "cluster") -> DataFrame:
    return members.groupBy(cluster).agg(F.count("*").alias("size"))


def larger_groups(rows: DataFrame, cluster: str = "cluster", more_than: int = MIN_GROUP) -> DataFrame:
    """Rows of clusters with more than ``more_than`` rows."""
    kept = cluster_sizes(rows, cluster).where(F.col("size") > more_than).select(cluster)
    return rows.join(broadcast_if_bounded(kept), cluster, "left_semi")


def subcluster_features(flows: DataFrame, members: DataFrame) -> DataFrame:
    """Application features of each member address inside its cluster, for all clusters in one job.

    ``members`` hold (ip, cluster), one row per address. Within one cluster a flow counts for its
    source if that is a member, else for its destination; a flow between two clusters counts once
    in each. Clusters of three addresses or fewer, before or after, are left out.
    """
    groups = larger_groups(members)
    side = lambda end: broadcast_if_bounded(
        groups.select(F.col("ip").alias(f"_{end}"), F.col("cluster").alias(f"{end}_cluster")))
    joined = (
        flows.join(side("src"), F.col("srcip") == F.col("_src"), "left")
        .join(side("dst"), F.col("dstip") == F.col("_dst"), "left"))
    as_src = F.when(F.col("src_cluster").isNotNull(), F.struct(
        F.col("src_cluster").alias("cluster"), F.col("srcip").alias("ip")))
    other = F.col("dst_cluster").isNotNull() & ~F.col("dst_cluster").eqNullSafe(F.col("src_cluster"))
    as_dst = F.when(other, F.struct(F.col("dst_cluster").alias("cluster"), F.col("dstip").alias("ip")))
    ends = F.filter(F.array(as_src, as_dst), lambda e: e.isNotNull())
    counted = (
        joined.select(F.explode(ends).alias("end"), "appproto", "method")
        .select("end.*", "appproto", "method").groupBy("cluster", "ip").agg(*_app_counts()))
    return larger_groups(counted)


def min_max(features: DataFrame, names: list[str]) -> DataFrame:
    """Global extremes of each feature in one row."""
    return features.agg(
        *[F.min(n).cast("double").alias(f"min_{n}") for n in names],
        *[F.max(n).cast("double").alias(f"max_{n}") for n in names])


def min_max_normalize(features: DataFrame, names: list[str], suffix: str = "_nor") -> DataFrame:
    """Scale each feature to 0..1; a constant feature becomes 0."""
    extremes = min_max(features, names)
    scaled = features.withColumn("_x", extremes.select(F.struct(*extremes.columns)).scalar())
    for n in names:
        low, high = F.col(f"_x.min_{n}"), F.col(f"_x.max_{n}")
        value = (F.col(n).cast("double") - low) / F.nullif(high - low, F.lit(0.0))
        scaled = scaled.withColumn(n + suffix, F.coalesce(value, F.lit(0.0)))
    return scaled.drop("_x")


def flow_features(flows: DataFrame) -> DataFrame:
    """Protocol code, duration, bytes and packets of each flow; unknown protocols are dropped."""
    code = F.lit(None).cast("double")
    for name, value in PROTO_CODES.items():
        code = F.when(F.upper("proto") == name, F.lit(float(value))).otherwise(code)
    columns = [
        code.alias("proto_code"), duration_ms().cast("double").alias("time_diff"),
        F.col("bytes").cast("double").alias("flow_num"), F.col("packets").cast("double").alias("packer_num")]
    return flows.select("dstip", "record_time", *columns).where("proto_code is not null")


FEATURE_COLUMNS = ["proto_code", "time_diff", "flow_num", "packer_num"]


def standardize(features: DataFrame, names: list[str], suffix: str = "_scl") -> DataFrame:
    """Divide each feature by its sample standard deviation, without centring; constant ones become 0."""
    deviations = features.agg(F.struct(*[F.stddev_samp(n).alias(n) for n in names]).alias("s"))
    scaled = features.withColumn("_s", deviations.scalar())
    for n in names:
        value = F.col(n) / F.nullif(F.col(f"_s.{n}"), F.lit(0.0))
        scaled = scaled.withColumn(n + suffix, F.coalesce(value, F.lit(0.0)))
    return scaled.drop("_s")


def centre_distance(points: DataFrame, centres: DataFrame, names: list[str]) -> DataFrame:
    """Distance of each point to the centre of its cluster, matched by label."""
    doubles = F.array(*[F.col(n).cast("double") for n in names])
    middle = centres.select(F.col("cluster").alias("_c"), doubles.alias("centre"))
    joined = points.join(broadcast_if_bounded(middle), F.col("cluster") == F.col("_c")).drop("_c")
    return joined.withColumn("distance", euclidean(doubles, F.col("centre"))).drop("centre")


def lookup_by_index(index: DataFrame, table: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Rows of a table whose key the time index lists between two times, both included."""
    keys = index.where(F.col("record_time").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return table.join(keys.select(key), key, "left_semi")
