"""Asset discovery from traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.search import count_at_most
from secflow.functions.text import ip_to_long, number_in_any, stable_id
from secflow.plans.physical import broadcast_if_bounded, evaluated_once

# How a flow is ordered among the sightings of one address.
SIGHTING_ORDER = ["record_time", "port", "protocol", "packets"]


def in_ranges(rows: DataFrame, ip: str, ranges: list[str]) -> DataFrame:
    """Rows whose address lies in a range, with the address as ``ip_number``."""
    numbered = evaluated_once(rows, "ip_number", ip_to_long(F.col(ip)))
    return numbered.where(number_in_any(F.col("ip_number"), ranges))


#: Ranges are cut at the borders of blocks of so many addresses (a power of two), here those of one /16.
RANGE_BLOCK_BITS = 16


def range_blocks(ranges: DataFrame, begin: str = "begin_ip", end: str = "end_ip") -> DataFrame:
    """One row per address block that a table of ranges touches, with its disjoint intervals in order.

    Ranges are cut at block borders and merged inside a block, so no step looks at all of them, and a
    block holds at most half as many intervals as addresses. Ranges without two addresses, or which
    end before they begin, hold nothing.
    """
    bounds = ranges.select(ip_to_long(F.trim(begin)).alias("lo"), ip_to_long(F.trim(end)).alias("hi")).where("lo <= hi").distinct()
    cut = bounds.withColumn("block", F.explode(F.sequence(
        F.shiftright("lo", RANGE_BLOCK_BITS), F.shiftright("hi", RANGE_BLOCK_BITS))))
    first = F.shiftleft("block", RANGE_BLOCK_BITS)
    inside = cut.select(
        "block", F.greatest("lo", first).alias("lo"),
        F.least("hi", first + ((1 << RANGE_BLOCK_BITS) - 1)).alias("hi")).groupBy("block", "lo").agg(F.max("hi").alias("hi"))
    before = Window.partitionBy("block").orderBy("lo")
    reached = F.max("hi").over(before.rowsBetween(Window.unboundedPreceding, -1))
    begun = inside.withColumn("new", F.coalesce(F.col("lo") > reached + 1, F.lit(True)).cast("int"))
    merged = begun.withColumn("part", F.sum("new").over(before)).groupBy("block", "part").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("intervals"))


def in_range_table(
    rows: DataFrame, ip: str, ranges: DataFrame, begin: str = "begin_ip", end: str = "end_ip"
) -> DataFrame:
    """Rows whose address lies in some range of a table of any size, with the address as ``ip_number``.

    Addresses meet the blocks in an equi-join, and their interval is found by halving inside the row.
    """
    numbered = evaluated_once(rows, "ip_number", ip_to_long(F.col(ip)))
    blocks = broadcast_if_bounded(range_blocks(ranges, begin, end).withColumnsRenamed(
        {"block": "_block", "intervals": "_intervals"}))
    met = numbered.join(blocks, F.shiftright("ip_number", RANGE_BLOCK_BITS) == F.col("_block"))
    place = count_at_most("_intervals", "lo", "ip_number")
    held = evaluated_once(met, "_place", place).where("_place > 0")
    return held.where(F.get("_intervals", F.col("_place") - 1)["hi"] >= F.col("ip_number")).select(*rows.columns, "ip_number")


def flows_in_ranges(flows: DataFrame, ranges: list[str]) -> DataFrame:
    """Flows with a monitored end, and which end: the source counts first."""
    both = F.struct(ip_to_long(F.col("srcip")).alias("src"), ip_to_long(F.col("dstip")).alias("dst"))
    numbered = evaluated_once(flows, "ends", both)
    side = (
        F.when(number_in_any(F.col("ends.src"), ranges), "src")
        .when(number_in_any(F.col("ends.dst"), ranges), "dst"))
    return evaluated_once(numbered, "side", side).where("side is not null").drop("ends")


def sightings(flows: DataFrame, ranges: list[str]) -> DataFrame:
    """Flows that prove a monitored address is alive: any source traffic but ICMP, or TCP of at
    least three packets towards it."""
    near = flows_in_ranges(flows, ranges)
    from_src = (F.col("side") == "src") & (F.col("proto") != "ICMP")
    to_dst = (F.col("side") == "dst") & (F.col("proto") == "TCP") & (F.col("packets") >= 3)
    is_src = F.col("side") == "src"
    return near.where(from_src | to_dst).select(
        F.when(is_src, F.col("srcip")).otherwise(F.col("dstip")).alias("ip"),
        F.when(is_src, F.col("srcport")).otherwise(F.col("dstport")).alias("port"),
        F.col("proto").alias("protocol"), "packets", "record_time")


def discover_assets(
    flows: DataFrame, registered: DataFrame, ranges: list[str], discovered: DataFrame | None = None,
    include_known: bool = False,
) -> DataFrame:
    """First sighting of every monitored address that is neither registered nor already discovered.

    The first sighting is a minimum, so it is found with map-side aggregation and only addresses
    are shuffled. With ``include_known`` registered addresses come too, with is_new = 0.
    """
    payload = F.struct(*SIGHTING_ORDER)
    first = sightings(flows, ranges).groupBy("ip").agg(F.min(payload).alias("seen"))
    known = registered.select(F.lower("device_ip").alias("known_ip")).where("known_ip is not null").distinct()
    if discovered is not None:
        seen_before = discovered.select(F.lower("ip").alias("found_ip")).distinct()
        first = first.join(broadcast_if_bounded(seen_before), F.lower("ip") == F.col("found_ip"), "left_anti")
    known = broadcast_if_bounded(known)
    on = F.lower("ip") == F.col("known_ip")
    if include_known:
        flagged = first.join(known, on, "left").withColumn("is_new", F.when(F.col("known_ip").isNull(), 1).otherwise(0))
    else:
        flagged = first.join(known, on, "left_anti").withColumn("is_new", F.lit(1))
    return flagged.select(
        stable_id("asset", F.col("ip")).alias("record_id"), "ip", "is_new", F.lit(0).alias("flg"),
        F.col("seen.record_time").alias("storage_time"), F.col("seen.protocol").alias("protocol"),
        F.col("seen.port").alias("port"), F.col("seen.packets").alias("package_num"))
