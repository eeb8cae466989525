"""k-means of many groups of points at once, as DataFrame jobs.

One job per iteration serves all groups and all candidate counts: points meet the centres of their
group, take the nearest, and are averaged with map-side combining. Only centres travel, a row per
group and count. Fits are reproducible: first centres are chosen farthest first, not at random, and
centres are rounded to nine decimals, so the order in which partitions add up does not show.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.plans.physical import broadcast_if_bounded, checkpointed

DECIMALS = 9


def _small(state: DataFrame) -> DataFrame:
    """Centres as a local table if their measured size allows it, else checkpointed: no lineage is kept."""
    local = broadcast_if_bounded(state)
    return checkpointed(state) if local is state else local


def group_points(features: DataFrame, names: list[str], parent: str | None = None) -> DataFrame:
    """Features plus ``parent`` and ``x``, the features scaled to 0..1 inside each group.

    A constant or missing feature becomes 0. Without ``parent`` all rows are one group, 0. The result
    is checkpointed, since every iteration reads it.
    """
    rows = features.withColumnRenamed(parent, "parent") if parent else features.withColumn("parent", F.lit(0))
    extremes = rows.groupBy("parent").agg(
        *[F.min(n).cast("double").alias(f"_min_{n}") for n in names],
        *[F.max(n).cast("double").alias(f"_max_{n}") for n in names])
    scaled = [
        F.coalesce((F.col(n).cast("double") - F.col(f"_min_{n}"))
                   / F.nullif(F.col(f"_max_{n}") - F.col(f"_min_{n}"), F.lit(0.0)), F.lit(0.0)) for n in names]
    joined = rows.join(broadcast_if_bounded(extremes), "parent")
    return checkpointed(joined.select(*rows.columns, F.array(*scaled).alias("x")))


def _squares(x: Column, centres: Column, width: int) -> Column:
    """Squared distance from ``x`` to each centre; features are added in order."""
    def one(centre: Column) -> Column:
        total = F.lit(0.0)
        for i in range(width):
            off = F.get(x, F.lit(i)) - F.get(centre, F.lit(i))
            total = total + off * off
        return total

    return F.transform(centres, one)


def _nearest(points: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """Points by the centres of their group: ``cluster``, of equal distances the first, and ``square``."""
    met = points.join(state, "parent").withColumn("_all", _squares(F.col("x"), F.col("centres"), width))
    met = met.withColumn("square", F.array_min("_all"))
    return met.withColumn("cluster", (F.array_position("_all", F.col("square")) - 1).cast("int")).drop("_all")


def first_centres(points: DataFrame, width: int, most: int) -> DataFrame:
    """(parent, centres): the greatest point, then each time the point farthest from those taken.

    A group gets no more centres than it has different points.
    """
    state = _small(points.groupBy("parent").agg(F.array(F.max("x")).alias("centres")))
    for _ in range(most - 1):
        met = points.select("parent", "x").join(state, "parent")
        least = F.array_min(_squares(F.col("x"), F.col("centres"), width))
        far = met.select("parent", F.struct(least.alias("square"), "x").alias("_far")).groupBy("parent").agg(
            F.max("_far").alias("_far"))
        grown = F.when(F.col("_far.square") > 0, F.concat("centres", F.array("_far.x"))).otherwise(F.col("centres"))
        state = _small(state.join(far, "parent").select("parent", grown.alias("centres")))
    return state


def _moved(points: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """One iteration: every centre moves to the mean of its points; one without points stays."""
    near = _nearest(points.select("parent", "x"), state.select("parent", "k", "centres"), width)
    mean = F.array(*[F.round(F.avg(F.get("x", F.lit(i))), DECIMALS) for i in range(width)])
    means = near.groupBy("parent", "k", "cluster").agg(mean.alias("_mean"))
    # at most k entries a row
    found = means.groupBy("parent", "k").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "_mean"))).alias("_found"))
    moved = F.transform("centres", lambda c, i: F.coalesce(F.try_element_at("_found", i), c))
    joined = state.select("parent", "k", F.col("centres").alias("_old")).join(found, ["parent", "k"])
    joined = joined.withColumnRenamed("_old", "centres").withColumn("_new", moved)
    return joined.select("parent", "k", F.col("_new").alias("centres"), (F.col("_new") != F.col("centres")).alias("moving"))


def fit_groups(points: DataFrame, width: int, candidates: Iterable[int], iterations: int) -> DataFrame:
    """(parent, k, centres) of every group and candidate count, iterated until no centre moves."""
    counts = sorted(set(candidates))
    first = first_centres(points, width, counts[-1])
    state = first.select("parent", "centres", F.explode(F.array(*[F.lit(k) for k in counts])).alias("k"))
    state = _small(state.select("parent", "k", F.slice("centres", F.lit(1), F.col("k")).alias("centres"),
                                F.lit(True).alias("moving")))
    for _ in range(iterations):
        moving = state.where("moving")
        if moving.isEmpty():
            break
        state = _small(_moved(points, moving, width).unionByName(state.where("not moving")))
    return state.select("parent", "k", "centres")


def label(points: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """Points with ``cluster`` and the ``distance`` to its centre, both in the scaled space."""
    near = _nearest(points, _small(state), width)
    return near.withColumn("distance", F.sqrt("square")).drop("square", "centres")


def group_scores(points: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """(parent, k, silhouette, cost): mean silhouette over squared distances, and sum of squares to centres.

    The mean distance of a point to a cluster follows from the cluster's size, sum and sum of
    squares, so no pairs of points are formed. A point alone in its cluster counts 0, as do all points
    of a group with one cluster.
    """
    state = _small(state)
    near = _nearest(points.select("parent", "x"), state, width).drop("centres")
    norm = sum((F.get("x", F.lit(i)) * F.get("x", F.lit(i)) for i in range(width)), F.lit(0.0))
    totals = near.groupBy("parent", "k", "cluster").agg(
        F.count("*").cast("double").alias("n"), F.avg(norm).alias("norm"),
        F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(width)]).alias("mean"))
    # at most k entries a row
    facts = _small(totals.groupBy("parent", "k").agg(
        F.collect_list(F.struct("cluster", "n", "norm", "mean")).alias("_facts")))
    own = near.withColumn("_norm", norm).join(facts, ["parent", "k"])

    def away(f: Column) -> Column:
        dot = sum((F.get("x", F.lit(i)) * F.get(f["mean"], F.lit(i)) for i in range(width)), F.lit(0.0))
        return F.greatest(F.col("_norm") + f["norm"] - 2 * dot, F.lit(0.0))

    mine = F.get(F.filter("_facts", lambda f: f["cluster"] == F.col("cluster")), F.lit(0))
    others = F.array_min(F.transform(F.filter("_facts", lambda f: f["cluster"] != F.col("cluster")), away))
    own = own.withColumn("_mine", mine).withColumn("_b", others)
    own = own.withColumn("_a", away(F.col("_mine")) * F.col("_mine.n") / F.nullif(F.col("_mine.n") - 1, F.lit(0.0)))
    score = F.coalesce((F.col("_b") - F.col("_a")) / F.nullif(F.greatest("_a", "_b"), F.lit(0.0)), F.lit(0.0))
    score = F.when(F.col("_mine.n") == 1, 0.0).when(F.col("_b").isNull(), 0.0).otherwise(score)
    return own.withColumn("_s", score).groupBy("parent", "k").agg(F.avg("_s").alias("silhouette"), F.sum("square").alias("cost"))


def best_groups(points: DataFrame, width: int, candidates: Iterable[int], iterations: int) -> DataFrame:
    """(parent, k, centres) with the count of the best silhouette of each group, of equal ones the smallest."""
    counts = sorted(set(candidates))
    state = fit_groups(points, width, counts, iterations)
    if len(counts) == 1:
        return state
    state = _small(state)
    scored = group_scores(points, state, width).select(
        "parent", "k", F.struct(F.round("silhouette", DECIMALS).alias("s"), (-F.col("k")).alias("less")).alias("_rank"))
    best = scored.groupBy("parent").agg(F.max_by("k", "_rank").alias("k"))
    return state.join(_small(best), ["parent", "k"])
