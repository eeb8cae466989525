"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source gets a share of the budget in proportion to its weight. A share above ``epochs`` times
the source's size is clamped, and the excess is shared again among the others until none is above.
Rows then take whole repetitions, and a seeded part of the rows takes the fraction: rows fall into
hash buckets, buckets below the cut are taken once more, and the bucket at the cut is divided again
by further hash bits. No source is ever gathered in one task: only bucket sums are windowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.llm.common import WORD, stored
from secflow.plans.physical import broadcast_if_bounded

#: Hash buckets per source and level. Two levels divide a source into 16 million parts.
BUCKETS = 4096
SEED = 20240229


def sized(docs: DataFrame) -> DataFrame:
    """Add ``size``, the words of the text; 0 for null."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def water_fill(sources: DataFrame, share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """``target`` for each row of (source, source_size, weight): ``share`` of all sizes by weight, at most
    ``epochs`` times the source's size, excess shared again.

    Each round clamps the sources above their cap and takes one sum over all; the loop runs at most
    once for each source that is clamped. With ``share`` above ``epochs`` every source ends at its cap.
    """
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * share).first()[0]
    cap = F.col("source_size") * F.lit(epochs)
    clamped, numerator, weights = F.lit(False), budget, None
    open_before = None
    while True:
        row = sources.where(~clamped).agg(
            F.count("*").alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
        if row["n"] == 0 or row["n"] == open_before:
            break
        taken = sources.where(clamped).agg(F.coalesce(F.sum(cap), F.lit(0.0))).first()[0]
        open_before, numerator, weights = row["n"], budget - taken, row["w"]
        clamped = F.lit(numerator) * F.col("weight") / F.lit(weights) > cap
    if weights is None:
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.when(clamped, cap).otherwise(
        F.lit(numerator) * F.col("weight") / F.lit(weights)))


def ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 in code point order, null last.

    There is one row per source here. Ranks come from prefixes' counts, so that no task holds more
    than the sources that share their first two characters.
    """
    cut = sources.withColumn("_head", F.substring("source", 1, 2))
    by_head = Window.orderBy(F.col("_head").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    heads = cut.groupBy("_head").agg(F.count("*").alias("_n"))
    heads = heads.withColumn("_before", F.coalesce(F.sum("_n").over(by_head), F.lit(0)))
    inner = Window.partitionBy("_head").orderBy(F.col("source").asc_nulls_last())
    placed = cut.withColumn("_place", F.row_number().over(inner) - 1)
    joined = placed.join(heads.withColumnRenamed("_head", "_h"), F.col("_head").eqNullSafe(F.col("_h")))
    return joined.withColumn("rank", (F.col("_before") + F.col("_place")).cast("long")).drop(
        "_head", "_h", "_n", "_before", "_place")


def _cut_bucket(sums: DataFrame, keys: list[str], amount: str, bucket: str) -> DataFrame:
    """Per key the bucket in which the running sum passes the amount, and what is left of it there."""
    order = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("_upto", F.sum("_size").over(order))
    inside = (F.col("_upto") > F.col(amount)) & (F.col("_upto") - F.col("_size") <= F.col(amount))
    return run.where(inside).select(
        *keys, F.col(bucket).alias(f"{bucket}_cut"), (F.col(amount) - F.col("_upto") + F.col("_size")).alias("_left"),
        F.col("_size").alias("_there"))


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = SEED,
) -> DataFrame:
    """The documents with size, source_size, target and ``taken``, the words that the mix takes of each.

    ``weights`` repeat over the sources in code point order, null last. Rows are told apart by id and
    text; equal rows take equally. A row in the last, smallest bucket at the cut takes that share of
    its words, so a source's sum differs from its target by less than a word per row there. Null or
    blank texts have size 0 and take 0. An empty table gives an empty one.
    """
    rows = sized(docs)
    h = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed))
    first = F.pmod(h, F.lit(BUCKETS)).cast("int")
    second = F.pmod(F.shiftrightunsigned(h, 20), F.lit(BUCKETS)).cast("int")
    spread = rows.withColumns({"_b1": first, "_b2": second})
    fine = stored(
        spread.groupBy("source", "_b1").agg(F.sum("size").alias("_size")), "mix-sums")
    sources = fine.groupBy("source").agg(F.sum("_size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = ranked(sources).withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(weights))).cast("int")))
    weighed = stored(weighed.select("source", "source_size", "weight"), "mix-sources")
    filled = water_fill(weighed, share, epochs)
    # words to take: whole repetitions of every row, and this much more
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    plan = filled.withColumn("_whole", whole).withColumn("_more", goal - F.col("_whole") * F.col("source_size"))
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))
    plan = stored(plan.withColumn("_key", key).drop("source", "weight"), "mix-plan")
    cut1 = _cut_bucket(
        fine.withColumn("_key", key).drop("source").join(plan.select("_key", "_more"), "_key"), ["_key"], "_more", "_b1")
    level1 = plan.join(cut1.withColumnsRenamed({"_left": "_left1"}).drop("_there"), "_key", "left")
    level1 = stored(level1, "mix-cut")
    keyed = spread.withColumn("_key", key)
    at_cut = keyed.select("_key", "_b1", "_b2", "size").join(
        broadcast_if_bounded(level1.select("_key", "_b1_cut", "_left1")), "_key").where(F.col("_b1") == F.col("_b1_cut"))
    sums2 = at_cut.groupBy("_key", "_b2").agg(F.sum("size").alias("_size"), F.first("_left1").alias("_left1"))
    cut2 = _cut_bucket(sums2, ["_key"], "_left1", "_b2")
    cuts = level1.join(cut2, "_key", "left")
    # one row a source: broadcast when its measured size allows, so that a hot source stays where it is
    joined = keyed.join(broadcast_if_bounded(cuts), "_key")
    part = F.floor(F.col("size") * F.col("_left") / F.col("_there")).cast("long")
    more = (
        F.when(F.col("_b1_cut").isNull(), F.lit(0).cast("long"))
        .when(F.col("_b1") < F.col("_b1_cut"), F.col("size"))
        .when(F.col("_b1") > F.col("_b1_cut"), F.lit(0).cast("long"))
        .when(F.col("_b2") < F.col("_b2_cut"), F.col("size"))
        .when(F.col("_b2") > F.col("_b2_cut"), F.lit(0).cast("long"))
        .otherwise(part))
    taken = (F.col("_whole") * F.col("size") + more).alias("taken")
    return joined.select(*docs.columns, "size", "source_size", "target", taken)


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows repeated as taken; a last, partial repetition ends after its share of words.

    Columns are those of the input; ``n_chars``, where present, follows the text.
    """
    rows = mixed(docs.select("doc_id", "text", "source", *[c for c in docs.columns if c not in ("doc_id", "text", "source")]),
                 **options)
    full = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") - full * F.col("size")).otherwise(0).cast("int")
    # the first `rest` words with what stands between them
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    start = F.concat_ws("", F.slice(pieces, F.lit(1), rest))
    copies = F.concat(
        F.array_repeat(F.col("text"), full), F.when(rest > 0, F.array(start)).otherwise(F.array().cast("array<string>")))
    out = rows.withColumn("_copy", F.explode(copies)).withColumn("text", F.col("_copy"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

