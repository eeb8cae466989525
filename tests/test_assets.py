import datetime as dt
import math

from pyspark.sql import functions as F

from secflow.operators import assets, clusters, profile
from secflow.plans.tables import MONITORED_PREFIXES, MONITORED_RANGES, frame
from secflow.sources import readers

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("srcip string, dstip string, srcport int, dstport int, proto string, packets long, bytes long,"
          " start_time timestamp, end_time timestamp, record_time timestamp")
SF = "/root/testdata/sf0.001"


def _flow(src, dst, proto="TCP", packets=5, at=0, sport=1, dport=2):
    t = T0 + dt.timedelta(seconds=at)
    return src, dst, sport, dport, proto, packets, 100, t, t + dt.timedelta(milliseconds=1500), t


def _flows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_discovery_rules(spark):
    near, far, edge = "221.176.64.9", "9.9.9.9", "221.176.69.11"
    flows = _flows(
        spark, _flow(near, far, "ICMP", at=0), _flow(near, far, "UDP", at=2, sport=7), _flow(near, far, "UDP", at=1, sport=9),
        _flow(far, edge, "TCP", 2), _flow(far, edge, "TCP", 3, at=5, dport=80), _flow(far, "221.176.69.12", "TCP", 9),
        _flow("221.176.70.1", "221.176.70.2", "ICMP"), _flow(far, "221.176.65.1"), _flow("221.176.68.3", far))
    known = spark.createDataFrame([("221.176.65.1",), (None,)], "device_ip string")
    rows = {r.ip: r for r in assets.discover_assets(flows, known, MONITORED_RANGES).collect()}
    # a monitored source shadows the destination, even when the flow itself does not qualify
    assert set(rows) == {near, edge, "221.176.68.3"}
    assert (rows[near].port, rows[near].storage_time) == (9, T0 + dt.timedelta(seconds=1))
    assert (rows[edge].port, rows[edge].package_num, rows[edge].is_new) == (80, 3, 1)
    found = spark.createDataFrame([(edge,)], "ip string")
    flagged = assets.discover_assets(flows, known, MONITORED_RANGES, found, include_known=True).collect()
    assert {(r.ip, r.is_new) for r in flagged} == {(near, 1), ("221.176.68.3", 1), ("221.176.65.1", 0)}


def test_flow_profile(spark):
    flows = _flows(spark, _flow("221.176.64.1", "221.176.65.1"), _flow("1.1.1.1", "221.176.65.1", "GRE"), _flow("221.176.66.1", "1.1.1.1"))
    rows = {r.ip: r for r in profile.flow_profile(flows, MONITORED_PREFIXES).collect()}
    assert set(rows) == {"221.176.64.1", "221.176.65.1"}
    r = rows["221.176.65.1"]
    assert (r.time, r.packernum, r.bytesize, r.TCP, r.GRE) == (1500, 5, 100, 0, 1)


def test_subclusters_count_once_per_cluster(spark):
    members = spark.createDataFrame(
        [(f"a{i}", 1) for i in range(4)] + [(f"b{i}", 2) for i in range(4)] + [("c0", 3)], "ip string, cluster int")
    pairs = [("a0", "a1"), ("a0", "b0"), ("x", "b1"), ("c0", "x")] + [(f"a{i}", "y") for i in range(4)] + [
        ("z", f"b{i}") for i in range(4)]
    flows = spark.createDataFrame([(s, d, "QQ", "GET") for s, d in pairs], "srcip string, dstip string, appproto string, method string")
    got = {(r.cluster, r.ip): r.QQ for r in profile.subcluster_features(flows, members).collect()}
    assert got == {(1, "a0"): 3, (1, "a1"): 1, (1, "a2"): 1, (1, "a3"): 1, (2, "b0"): 2, (2, "b1"): 2, (2, "b2"): 1, (2, "b3"): 1}


def test_scaling_of_constants(spark):
    rows = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, c double")
    scaled = [(r.x_nor, r.c_nor) for r in profile.min_max_normalize(rows, ["x", "c"]).orderBy("x").collect()]
    assert scaled == [(0.0, 0.0), (1.0, 0.0)]
    std = [(round(r.x_scl, 6), r.c_scl) for r in profile.standardize(rows, ["x", "c"]).orderBy("x").collect()]
    assert std == [(round(1 / math.sqrt(2), 6), 0.0), (round(3 / math.sqrt(2), 6), 0.0)]


def test_incomplete_flows_are_dropped(spark):
    good = _flow("a", "b")
    rows = [good] + [tuple(None if i == j else v for i, v in enumerate(good)) for j in range(10)]
    kept = readers.complete_netflow(spark.createDataFrame(rows, SCHEMA)).collect()
    # ports, protocol and record time may be missing
    assert len(kept) == 5 and all(r.srcip and r.dstip and r.packets and r.bytes for r in kept)
    ranged = readers.in_time_range(_flows(spark, _flow("a", "b", at=0), _flow("a", "b", at=10)), "2024-01-01 00:00:00", "2024-01-01 00:00:10")
    assert ranged.count() == 1


def test_unknown_protocols_leave_the_flow_model(spark):
    rows = profile.flow_features(_flows(spark, _flow("a", "b", "tcp"), _flow("a", "b", "SCTP"), _flow("a", "b", None))).collect()
    assert [(r.proto_code, r.time_diff, r.flow_num, r.packer_num) for r in rows] == [(1.0, 1500.0, 100.0, 5.0)]


def test_first_level_clusters(spark):
    features = profile.flow_profile(frame(spark, SF, "netflow"), MONITORED_PREFIXES)
    level = clusters.first_level(features, candidates=(2, 3))
    rows = level.select("ip", "cluster", "distance").collect()
    assert len(rows) == features.count() and all(r.distance >= 0 for r in rows)
    assert sum(r["size"] for r in profile.cluster_sizes(level).collect()) == len(rows)
    stored = clusters.point_rows(level, profile.FLOW_FEATURES, "batch", "2024-01-01 00:00:00").first()
    assert len(stored.center_info.split("#")) == 7 and stored.demo == "TCP#ICMP#GRE#UDP#time#packernum#bytesize"


def test_second_level_runs_inside_clusters(spark):
    members = spark.createDataFrame([(f"i{i}", i % 2) for i in range(16)] + [("lone", 5)], "ip string, cluster int")
    kinds = profile.APP_PROTOCOLS
    flows = spark.createDataFrame(
        [(f"i{i}", "out", kinds[(i // 2) % 2 + j % 2], "GET") for i in range(16) for j in range(3)] + [("lone", "out", "QQ", "GET")],
        "srcip string, dstip string, appproto string, method string")
    rows = clusters.second_level(flows, members, candidates=(2,)).select("parent", "ip", "cluster").collect()
    assert {r.parent for r in rows} == {0, 1} and len(rows) == 16 and {r.cluster for r in rows} == {0, 1}
    # more clusters than members asked for: nobody is left out
    assert clusters.second_level(flows, members, candidates=(40,)).count() == 16


def test_groups_of_four_are_clustered(spark):
    members = spark.createDataFrame([(f"i{i}", int(i >= 4)) for i in range(9)], "ip string, cluster int")
    flows = spark.createDataFrame(
        [(f"i{i}", "out", profile.APP_PROTOCOLS[i % 3], "GET") for i in range(9)],
        "srcip string, dstip string, appproto string, method string")
    rows = clusters.second_level(flows, members).collect()
    assert sorted(r.ip for r in rows) == [f"i{i}" for i in range(9)]


def test_elbow_finds_separate_groups(spark):
    rows = [(x + dx, y + dy) for x, y in ((0.0, 0.0), (50.0, 0.0), (0.0, 50.0)) for dx in (0.0, 0.5, 1.0) for dy in (0.0, 0.5, 1.0)]
    points = clusters.assemble(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    assert clusters.best_by_cost(points, 7)[0] == 3


def test_centres_and_cost_choice(spark):
    features = profile.flow_features(frame(spark, SF, "netflow"))
    scaled = profile.standardize(features, profile.FEATURE_COLUMNS)
    points = clusters.assemble(scaled, [n + "_scl" for n in profile.FEATURE_COLUMNS])
    best, model = clusters.best_by_cost(points, 4)
    assert 2 <= best <= 4
    rows = clusters.centre_rows(spark, model, profile.FEATURE_COLUMNS, "b", "t", 2, parent=1, parent_batch="p").collect()
    assert len(rows) == best and {(r.type, r.center_index_p, r.clno_p) for r in rows} == {(2, "1", "p")}


def test_lookup_by_index(spark):
    index = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=2))], "rowkey int, record_time timestamp")
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "rowkey int, v string")
    got = profile.lookup_by_index(index, table, "rowkey", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert sorted(r.v for r in got.collect()) == ["a", "b"]


def test_profile_aggregates_before_the_shuffle(spark):
    plan = profile.flow_profile(frame(spark, SF, "netflow"), MONITORED_PREFIXES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Python" not in plan
    assert "l_tax" not in plan.split("ReadSchema")[1]
    discovery = assets.discover_assets(frame(spark, SF, "netflow"), frame(spark, SF, "registered"), MONITORED_RANGES)
    assert "BroadcastHashJoin" in discovery._jdf.queryExecution().executedPlan().toString()
    assert discovery.where(F.col("ip").isNull()).count() == 0


def test_range_table_by_plain_search(spark):
    """Overlapping, touching, nested, empty and malformed ranges, and ranges across block borders."""
    import ipaddress
    import random

    rng = random.Random(4)
    number = lambda ip: int(ipaddress.ip_address(ip))
    text = lambda n: str(ipaddress.ip_address(n))
    spans = [("10.0.0.5", "10.0.0.9"), ("10.0.0.8", "10.0.0.20"), ("10.0.0.21", "10.0.0.22"), ("10.0.0.1", "10.0.0.30"),
             ("10.0.255.250", "10.2.0.3"), ("11.0.0.9", "11.0.0.1"), ("12.0.0.7", "12.0.0.7")]
    spans += [(text(a), text(a + rng.randrange(3000))) for a in (number("10.3.0.0") + rng.randrange(60_000) for _ in range(60))]
    rows = [(text(number("10.0.0.0") + k),) for k in range(40)] + [
        (x,) for x in ("10.0.255.249", "10.0.255.250", "10.1.7.7", "10.2.0.3", "10.2.0.4", "11.0.0.5", "12.0.0.7", None, "x", "")]
    rows += [(text(number("10.3.0.0") + rng.randrange(70_000)),) for _ in range(400)]
    table = spark.createDataFrame([*spans, ("1.2.3", "1.2.3.4"), (None, "9.9.9.9"), spans[0]], "begin_ip string, end_ip string")
    got = assets.in_range_table(spark.createDataFrame(rows, "ip string"), "ip", table)
    held = [(number(a), number(b)) for a, b in spans]
    expected = sorted(ip for (ip,) in rows if ip and ip.count(".") == 3 and any(a <= number(ip) <= b for a, b in held))
    assert sorted(r.ip for r in got.collect()) == expected and 100 < len(expected) < 440
    intervals = assets.range_blocks(table).select(F.explode("intervals").alias("i")).select("i.*").orderBy("lo").collect()
    assert all(x.hi < y.lo for x, y in zip(intervals, intervals[1:]))
