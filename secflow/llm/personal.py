"""Personal data: base patterns, and contexts learnt from them that find further identifiers.

Base spans are matches of four patterns that pass their checks. Around them the operator bootstraps:
every token with a digit is a candidate; the word before it, and the two words before it, are its
contexts, with digits folded and an earlier candidate written as #. Values that pass a base check are
seeds. Contexts and values form a graph; in each round a context's score for a kind is the smoothed
mean of its values' scores, and a context of high score and enough supporting values is learnt. A
value's score is the noisy-or of its learnt contexts, and a confident value supports further contexts
in the next round, until none is added. Learnt contexts mark their other values as spans of that kind.

All matching happens inside the row, in one scan whose narrow result is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import same_row, stored, text_or_empty
from secflow.plans.physical import evaluated_once

KINDS = ("email", "ip", "card", "phone")
# Leftmost matches as the plain patterns give them. Possessive repeats and the look-behind only spare
# the engine tries that cannot succeed; \G lets a match follow another directly.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: A candidate: a token of identifier characters with a digit, not preceded by such a character.
CANDIDATE = r"(?<![A-Za-z0-9@._%+-])[A-Za-z@._%+-]*+[0-9][A-Za-z0-9@._%+-]*+"
MIN_DIGITS = 5  # of a value that a context may mark
ROUNDS = 10  # at most; rounds end when no context is added
MIN_SCORE = 0.6
MIN_SEEDS = 3  # different values that support a context
CONFIDENT = 0.8  # score from which a learnt value supports contexts as a seed does


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(_IP)
    if kind == "card":
        digits = F.regexp_replace(x, r"[\x20-]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(x, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _ends(found: str, gaps: str) -> Column:
    """End of each match: lengths of gaps and matches, added up. The list grows as text, which is cheap."""
    return F.expr(f"""
        transform(filter(split(aggregate(sequence(0, size({found}) - 1), named_struct('at', 0L, 'all', ''),
          (a, k) -> named_struct(
            'at', a.at + length(get({gaps}, k)) + length(get({found}, k)),
            'all', concat(a.all, cast(a.at + length(get({gaps}, k)) + length(get({found}, k)) as string), ',')),
          a -> a.all), ','), x -> x <> ''), x -> cast(x as bigint))""")


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
_CANDS = "array<struct<start:bigint,end:bigint,value:string,contexts:array<string>,seed:int>>"


def _spans(rows: DataFrame, kind: str) -> DataFrame:
    """Add the valid spans of a kind, as column named after it."""
    number = KINDS.index(kind)
    found, gaps, ends = f"_{kind}_found", f"_{kind}_gaps", f"_{kind}_ends"
    pattern = F.lit(PATTERNS[kind])
    rows = evaluated_once(rows, found, F.regexp_extract_all("_text", pattern, F.lit(0)))
    # matches of which none is valid need no places
    some = F.exists(found, lambda x: _valid(kind, x))
    rows = evaluated_once(rows, gaps, F.when(some, F.split("_text", PATTERNS[kind], -1)))
    rows = evaluated_once(rows, ends, F.when(F.col(gaps).isNotNull(), _ends(found, gaps)))
    spans = F.transform(
        F.filter(F.arrays_zip(F.col(found).alias("m"), F.col(ends).alias("e")), lambda z: _valid(kind, z["m"])),
        lambda z: F.struct(
            (z["e"] - F.length(z["m"])).alias("start"), F.lit(number).alias("kind"), z["e"].alias("end")))
    rows = rows.withColumn(kind, F.when(F.col(gaps).isNotNull(), spans).otherwise(F.array().cast(_SPANS)))
    return rows.drop(found, gaps, ends)


def _seed(x: Column) -> Column:
    """Kind of a token that passes a base check by itself, else -1. A leading +digit starts a phone number."""
    return (
        F.when(x.rlike(rf"^{PATTERNS['email'][len('(?:' + chr(92) + 'G|(?<![A-Za-z0-9._%+-]))'):]}$"), 0)
        .when(x.rlike(_IP), 1)
        .when(x.rlike(r"^[0-9](?:-?[0-9])++$") & _valid("card", x), 2)
        .when(x.rlike(r"^\+[0-9]"), 3).otherwise(-1))


def _candidates(rows: DataFrame) -> DataFrame:
    rows = evaluated_once(rows, "_found", F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0)))
    rows = evaluated_once(rows, "_gaps", F.when(F.size("_found") > 0, F.split("_text", CANDIDATE, -1)))
    rows = evaluated_once(rows, "_ends", F.when(F.col("_gaps").isNotNull(), _ends("_found", "_gaps")))
    zipped = F.arrays_zip(F.col("_found").alias("m"), F.col("_gaps").alias("g"), F.col("_ends").alias("e"))
    cands = F.transform(
        F.filter(zipped, lambda z: z["m"].isNotNull()),
        lambda z, k: F.struct(
            (z["e"] - F.length(z["m"])).alias("start"), z["e"].alias("end"), z["m"].alias("value"),
            _contexts(F.concat(F.when(k > 0, "#").otherwise(""), z["g"])).alias("contexts"), _seed(z["m"]).alias("seed")))
    kept = F.filter(cands, lambda c: F.size(c["contexts"]) > 0)
    return rows.withColumn(
        "cands", F.when(F.col("_gaps").isNotNull(), kept).otherwise(F.array().cast(_CANDS))).drop("_found", "_gaps", "_ends")


def _contexts(before: Column) -> Column:
    """The last word of a text, and its last two, lower-cased and with digits folded; words of signs only are none."""
    words = F.filter(F.split(before, r"[\x20\x09-\x0D]+"), lambda w: w.rlike(r"[A-Za-z0-9#]|[^\x00-\x7F]"))
    last = F.transform(F.slice(F.reverse(words), 1, 2), lambda w: F.regexp_replace(F.lower(w), "[0-9]+", "0"))
    two = F.when(F.size(last) == 2, F.concat_ws(" ", F.get(last, F.lit(1)), F.get(last, F.lit(0))))
    return F.filter(F.array(F.get(last, F.lit(0)), two), lambda c: c.isNotNull())


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), base spans and candidates of each row."""
    rows = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), text_or_empty().alias("_text"))
    for kind in KINDS:
        rows = _spans(rows, kind)
    return _candidates(rows).drop("_text")


def _long_enough(value: str = "value") -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", "")) >= MIN_DIGITS


def learnt_contexts(cands: DataFrame, rounds: int, min_score: float, min_seeds: int) -> DataFrame:
    """(context, kind, score) that were learnt, from rows of (context, value, seed); one kind a context."""
    # a value that no context may mark tells nothing about one
    fit = cands.where((F.col("seed") >= 0) | _long_enough())
    edges = stored(fit.groupBy("context", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("kind")
    fixed = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed") >= 0, 0.0)
    contexts, values, learnt = None, None, 0
    for _ in range(rounds):
        rows = edges.select("context", "value", "seed", kinds)
        if values is None:
            rows = rows.withColumn("_v", F.coalesce(fixed, F.lit(0.0)))
        else:
            rows = rows.join(values.withColumnsRenamed({"value": "_value", "kind": "_kind"}),
                             (F.col("value") == F.col("_value")) & (F.col("kind") == F.col("_kind")), "left")
            rows = rows.withColumn("_v", F.coalesce(fixed, "_score", F.lit(0.0)))
        scored = rows.groupBy("context", "kind").agg(
            (F.sum("_v") / (F.count("*") + 2)).alias("score"),
            F.count(F.when(F.col("_v") >= CONFIDENT, 1)).alias("support"))
        contexts = stored(
            scored.where((F.col("support") >= min_seeds) & (F.col("score") >= min_score)), "pii-contexts")
        now = contexts.count()
        if now == learnt:
            break
        learnt = now
        spread = edges.where("seed < 0").join(contexts, "context")
        values = spread.groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-0.9 * F.col("score"))))).alias("_score"))
    rank = F.struct("score", -F.col("kind"))
    return contexts.groupBy("context").agg(F.max_by("kind", rank).alias("kind"), F.max("score").alias("score"))


def personal_data(
    docs: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE, min_seeds: int = MIN_SEEDS,
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learnt and ``found`` of every row.

    Counts and base_sha256 are those of the base spans; ``spans`` lists all as kind:start:end, by start,
    then kind; ``found`` holds them as structures. Where contexts tell nothing, ``spans`` are the base
    spans. A null text is empty; equal rows get equal spans; null ids are rows of their own.
    """
    rows = stored(scan(docs), "pii-rows")
    cands = rows.select("doc_id", "th", F.explode("cands").alias("c")).select("doc_id", "th", "c.*")
    cands = cands.withColumn("context", F.explode("contexts")).drop("contexts")
    learnt = learnt_contexts(cands.select("context", "value", "seed"), rounds, min_score, min_seeds)
    hits = cands.where((F.col("seed") < 0) & _long_enough()).join(learnt, "context")
    hits = hits.groupBy("doc_id", "th", "start", "end").agg(
        F.max_by("kind", F.struct("score", -F.col("kind"))).cast("int").alias("kind"))
    hits = hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    joined = same_row(rows.drop("cands"), hits, ["doc_id", "th"])
    base = F.array_sort(F.concat(*KINDS))
    rows = joined.withColumn("_base", base)
    clear = F.filter(
        F.coalesce("more", F.array().cast(_SPANS)),
        lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    rows = rows.withColumn("_more", clear).withColumn("found", F.array_sort(F.concat("_base", "_more")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("_base"), 256).alias("base_sha256"), listed("found").alias("spans"),
        F.size("_more").cast("long").alias("n_learnt"), "found")
