"""Quality rules: base rules per document, and verdicts on hosts from shrunk failure rates.

Everything a rule needs is computed inside its row. Rates per source come from one aggregate with
map-side sums; a beta prior fitted to all sources by moments pulls the rates of small sources to the
mean; a document that passes goes nevertheless if its source fails on most of its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import WORD, stored, text_or_empty
from secflow.plans.physical import broadcast_if_bounded, evaluated_once

#: A source is refused when its shrunk failure rate is above this, for any rule or for all together.
MAX_RATE = 0.6


def base_features(docs: DataFrame) -> DataFrame:
    """doc_id, source and the base columns of each row; a null text has no words."""
    text = text_or_empty()
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("_text"))
    words = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    rows = evaluated_once(rows, "_words", words)
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.regexp_replace(x, r"[\x20\x09-\x0D]+", "")) > 0)
    rows = rows.select(
        "doc_id", "source", "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        "_text")
    rows = evaluated_once(rows, "_lines", lines).drop("_text")
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return rows


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words: words inside windows of three that occur twice or more in the text.

    Windows are sorted by hash, words and place, so equal ones stand side by side whatever the hash
    does. Each place whose window is repeated covers three words, less what the next place covers.
    """
    rows = rows.withColumn("_n", F.expr("cast(greatest(n_words - 2, 0) as int)"))
    windows = "arrays_zip(slice(_words, 1, _n), slice(_words, 2, _n), slice(_words, 3, _n))"
    rows = evaluated_once(rows, "_sorted", F.expr(
        f"sort_array(transform({windows}, (z, k) -> struct(xxhash64(z) as h, z as z, k as k)))")).drop("_words", "_lines")
    same = "(x.h = get(_sorted, {0}).h and x.z = get(_sorted, {0}).z)"
    rows = evaluated_once(rows, "_places", F.expr(f"""
        sort_array(transform(filter(_sorted, (x, i) ->
          (i > 0 and {same.format("i - 1")}) or (i + 1 < _n and {same.format("i + 1")})), x -> cast(x.k as bigint)))"""))
    rows = rows.drop("_sorted")
    repeated = F.expr("""
        aggregate(transform(_places, (p, k) -> if(k + 1 < size(_places), least(3L, get(_places, k + 1) - p), 3L)),
                  0L, (a, x) -> a + x)""")
    return rows.withColumn("n_repeat_words", repeated).drop("_places", "_n")


def host_rates(flags: DataFrame, rules: list[str]) -> DataFrame:
    """Per source the shrunk failure rate of each rule: (fails + a) / (rows + a + b).

    a and b fit mean and variance of the sources' raw rates; where the variance leaves no beta
    distribution (a single source, or no spread) the prior is the mean with a weight of 100 rows.
    """
    hosts = flags.groupBy("source").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(f"k_{r}") for r in rules])
    moments = hosts.agg(
        *[(F.sum(f"k_{r}") / F.sum("n")).alias(f"m_{r}") for r in rules],
        *[F.var_pop(F.col(f"k_{r}") / F.col("n")).alias(f"v_{r}") for r in rules]).first()
    rates = {}
    for r in rules:
        mean, var = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        weight = mean * (1 - mean) / var - 1 if var > 1e-12 else 100.0
        weight = weight if weight > 0 else 100.0
        rates[f"rate_{r}"] = (F.col(f"k_{r}") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.withColumns(rates).select("source", "n", *rates)


def quality(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """doc_id, the base columns, base_failed and kept of each row.

    ``kept`` is false if a base rule fails, or if the source's shrunk rate of any rule is above
    ``max_rate``. A null source is a source of its own. Repeated rows count each.
    """
    base = _with_repeats(base_features(docs))
    base = base.withColumns({
        "_short": F.col("n_words") < 50, "_repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words")})
    base = base.withColumn("base_failed", F.col("_short") | F.col("_repeats"))
    base = stored(base, "quality")
    rules = ["_short", "_repeats", "base_failed"]
    rates = host_rates(base, rules)
    bad = F.lit(False)
    for r in rules:
        bad = bad | (F.col(f"rate_{r}") > max_rate)
    refused = rates.select(
        F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")).alias("_key"), bad.alias("_bad"),
        F.col("rate_base_failed").alias("host_rate"))
    keyed = base.withColumn("_key", F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")))
    joined = keyed.join(broadcast_if_bounded(refused), "_key", "left")  # one row a source
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("_bad", F.lit(False))).alias("kept"))


SQL = r"""
with d as (
  select doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
g as (
  select doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as k from d where len(w) > 2)),
c as (select doc_id, k, count(*) over (partition by doc_id, g) as n from g),
r as (
  select doc_id, count(distinct spot) as n_repeat_words
  from (select doc_id, unnest(range(k, k + 3)) as spot from c where n > 1) group by doc_id),
b as (
  select d.doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join r using (doc_id)),
f as (
  select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2, n_words < 50 or 100 * n_repeat_words > 50 * n_words as f3
  from b),
h as (
  select source, rule, count(*) as n, sum(x::int) as k
  from (select source, unnest([1, 2, 3]) as rule, unnest([f1, f2, f3]) as x from f) group by all),
m as (select rule, sum(k) / sum(n) as mean, var_pop(k / n) as var from h group by rule),
p as (
  select rule, mean, case when var > 1e-12 and mean * (1 - mean) / var - 1 > 0 then mean * (1 - mean) / var - 1 else 100 end as weight
  from m),
v as (
  select source, bool_or((k + mean * weight) / (n + weight) > 0.6) as bad from h join p using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f3 as base_failed, not f3 and not bad as kept
from f join v on f.source is not distinct from v.source
"""
