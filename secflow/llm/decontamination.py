"""Benchmark decontamination: a prefix-filtered set join with exact containment.

A benchmark item gives windows of ``window`` consecutive words; shorter items are one window. A
window's shingles are its runs of up to ``shingle`` words. Documents are searched once for shingles
of the benchmark. Each window is then represented by its rarest shingle in the corpus alone (the
prefix that containment of the whole set needs), which gives candidate places; length and place
bounds drop those that cannot hold the window, and a candidate stands if every shingle of the window
is found at its own place. Words under an occurrence are hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import same_row, stored
from secflow.plans.physical import broadcast_if_bounded, evaluated_once

WINDOW = 13
SHINGLE = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(column: str) -> Column:
    """Words after lowering A-Z only. Text without other letters takes the faster function."""
    text = F.coalesce(F.col(column), F.lit(""))
    lowered = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, _BETWEEN, -1), "")


def _shingles(words: str, count: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words of an array, in order."""
    columns = ", ".join(f"slice({words}, {k + 1}, greatest({count} - {length - 1}, 0))" for k in range(length))
    return F.expr(f"transform(arrays_zip({columns}), z -> xxhash64(z))")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, win (hash of its words), length, and one row per shingle: offset, k (its words), h."""
    items = benchmark.select("item_id", words_of("text").alias("w")).withColumn("n", F.size("w")).where("n > 0")
    items = items.withColumn("length", F.least("n", F.lit(window)))
    starts = items.select(
        "item_id", "length", F.explode(F.expr("transform(sequence(0, n - length), s -> slice(w, s + 1, length))")).alias("w"))
    starts = starts.withColumn("win", F.expr("sha2(concat_ws(' ', w), 256)"))
    starts = starts.withColumn("k", F.least("length", F.lit(shingle)))
    rows = starts.select(
        "item_id", "win", "length", "k",
        F.posexplode(F.expr("transform(sequence(0, length - k), s -> slice(w, s + 1, k))")).alias("offset", "s"))
    hashed = F.lit(None).cast("long")
    for length in range(1, shingle + 1):
        fields = ", ".join(f"'{i}', s[{i}]" for i in range(length))
        hashed = F.when(F.col("k") == length, F.expr(f"xxhash64(named_struct({fields}))")).otherwise(hashed)
    return rows.withColumn("h", hashed).drop("s")


def found_windows(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Occurrences of windows: doc_id, th (hash of the text), start, win, length.

    ``docs`` has doc_id, th, w (words) and n_words.
    """
    lengths = sorted(r["k"] for r in windows.select("k").distinct().limit(shingle).collect())
    wanted = broadcast_if_bounded(windows.select(F.col("k").alias("bk"), F.col("h").alias("bh")).distinct())
    hits = None
    for k in lengths:
        hashes = evaluated_once(docs.where(F.col("n_words") >= k), "hs", _shingles("w", "n_words", k)).drop("w")
        places = hashes.select("doc_id", "th", "n_words", F.posexplode("hs").alias("pos", "h"))
        part = places.withColumn("k", F.lit(k)).join(
            wanted, (F.col("k") == F.col("bk")) & (F.col("h") == F.col("bh"))).drop("bk", "bh")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return docs.select("doc_id", "th", F.lit(0).alias("start"), F.lit("").alias("win"), F.lit(0).alias("length")).where("false")
    # equal rows give equal hits
    hits = stored(hits.distinct(), "hits")
    rarity = hits.groupBy("k", "h").agg(F.count("*").alias("seen"))
    ranked = windows.select("win", "length", "k", "offset", "h").distinct().join(rarity, ["k", "h"], "left").fillna(0, ["seen"])
    need = F.col("length") - F.col("k") + 1
    # the prefix: the rarest shingle of a window; a window with a shingle that never occurs is out
    prefix = ranked.groupBy("win", "length", "k").agg(F.min(F.struct("seen", "offset", "h")).alias("p")).where("p.seen > 0")
    prefix = prefix.select("win", "length", "k", F.col("p.offset").alias("first"), F.col("p.h").alias("h"))
    starts = hits.join(broadcast_if_bounded(prefix), ["k", "h"]).withColumn("start", F.col("pos") - F.col("first"))
    # place and length bounds
    starts = starts.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    starts = starts.select("doc_id", "th", "start", "win", "length", "k", need.alias("need")).distinct()
    rest = broadcast_if_bounded(ranked.select(F.col("win").alias("rw"), "offset", F.col("h").alias("rh")))
    checks = starts.join(rest, F.col("win") == F.col("rw")).withColumn("at", F.col("start") + F.col("offset"))
    placed = hits.select(
        F.col("doc_id").alias("hd"), F.col("th").alias("ht"), F.col("k").alias("hk"), "pos", F.col("h").alias("hh"))
    agreed = checks.join(
        placed, F.col("doc_id").eqNullSafe(F.col("hd")) & (F.col("th") == F.col("ht")) & (F.col("k") == F.col("hk"))
        & (F.col("at") == F.col("pos")) & (F.col("rh") == F.col("hh")))
    return agreed.groupBy("doc_id", "th", "start", "win", "length", "need").agg(
        F.count("*").alias("ok")).where("ok = need").drop("ok", "need")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = 20,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row.

    A null text or item has no words; equal rows get equal results; null ids are rows of their own.
    ``contaminated``: some word is hit, and ``share`` times the hit words reach all words.
    """
    hashed = F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th")
    rows = evaluated_once(docs.select("doc_id", hashed, "text"), "w", words_of("text")).drop("text")
    rows = rows.withColumn("n_words", F.size("w"))
    windows = stored(benchmark_windows(benchmark, window, shingle), "windows")
    found = stored(found_windows(rows, windows, shingle), "found")
    covered = found.select("doc_id", "th", F.explode(F.expr("sequence(start, start + length - 1)")).alias("at"))
    hit = covered.distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_hit"))
    owners = windows.select("win", "item_id").distinct()
    items = found.select("doc_id", "th", "win").distinct().join(broadcast_if_bounded(owners), "win")
    items = items.select("doc_id", "th", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("item")).alias("items"))
    keys = ["doc_id", "th"]
    result = same_row(hit, items, keys)
    narrow = docs.select("doc_id", hashed, F.size(words_of("text")).cast("long").alias("n_words"))
    joined = same_row(narrow, result, keys)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "th")


SQL = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, least(len(w), 13) as length, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as s from iw where len(w) > 0)),
sizes as (select distinct length from win),
spots as (
  select doc_id, s, length, array_to_string(w[s:s + length - 1], ' ') as win
  from (select doc_id, w, length, unnest(range(1, len(w) - length + 2)) as s from dw, sizes where len(w) >= length)),
found as (select doc_id, s, spots.length, item_id from spots join win using (win, length)),
hit as (
  select doc_id, count(distinct spot) as n_hit
  from (select doc_id, unnest(range(s, s + length)) as spot from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join hit using (doc_id) left join items using (doc_id)
"""
