"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters, as a multiset, are a binary vector: one dimension per letter and repetition. One
replaced letter changes two dimensions, one inserted or deleted letter changes one. The letters are
dealt to parts; at most k of them hold a changed dimension, so two near words agree on all the others.
Every choice of parts to keep gives an exact signature, the sorted letters of those parts.

Words of like letters are many, so a signature also holds the length and one half of the word: an edit
leaves the half in which it is not. That is exact too, and keeps signature groups small without a limit.
Near words meet in an equi-join on (length, half, kept parts) and are verified by their edit distance.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import CRC_STEPS_SQL, crc32_sql, stored
from secflow.plans.physical import broadcast_if_bounded, evaluated_once

MIN_LENGTH = 7
MIN_COUNT = 2
#: A near word is a form if it is so many times as frequent.
TIMES = 10
DELETED_EVERY = 31
#: Parts for words of equal length (two dimensions differ) and for one letter more (one differs).
REPLACED_PARTS = 4
INSERTED_PARTS = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of words, common ones first, so that dealing them in turn makes parts of like weight.
LETTERS = "etaoinsrhldcumfgpwybvkxjqz" + "".join(map(chr, range(0xC0, 0x100)))


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n: the words of all texts, after the planted deletions, with their occurrences."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")
    runs = runs.select(
        "id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.char_length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    found = runs.select(F.when(h % DELETED_EVERY == 0, without).otherwise(F.col("run")).alias("word"))
    counts = found.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _parts(parts: int) -> Column:
    """The word's letters in each part, sorted."""
    kept = [
        F.translate("word", "".join(c for k, c in enumerate(LETTERS) if k % parts != part), "") for part in range(parts)]
    return F.array(*[F.array_join(F.array_sort(F.split(letters, "")), "") for letters in kept])


def _signatures(kept: list[tuple[int, ...]], letters: str, length: Column) -> list[Column]:
    """Signatures for words whose pair has ``length`` as its shorter length: halves by choices of parts."""
    half = F.floor(length / 2).cast("int")
    out = []
    for side, text in enumerate((F.substring("word", F.lit(1), half), F.expr("word").substr(
            F.char_length("word") - length + half + 1, length - half))):
        for choice, chosen in enumerate(kept):
            fields = [F.get(F.col(letters), F.lit(p)) for p in chosen]
            out.append(F.xxhash64(F.lit(2 * choice + side), length, text, *fields))
    return out


def _choices(parts: int, changed: int) -> list[tuple[int, ...]]:
    """Ways to keep all but ``changed`` of the parts."""
    return list(itertools.combinations(range(parts), parts - changed))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: each pair of words one edit apart, once."""
    length = F.char_length("word")
    lettered = evaluated_once(vocabulary.select("word", "n"), "replaced", _parts(REPLACED_PARTS))
    lettered = evaluated_once(lettered, "inserted", _parts(INSERTED_PARTS))
    alike = _signatures(_choices(REPLACED_PARTS, 2), "replaced", length)
    shorter = _signatures(_choices(INSERTED_PARTS, 1), "inserted", length)
    longer = _signatures(_choices(INSERTED_PARTS, 1), "inserted", length - 1)

    def signed(columns: list[Column], side: str) -> DataFrame:
        return lettered.select(
            F.explode(F.array(*columns)).alias("signature"), F.col("word").alias(side), F.col("n").alias(f"{side}_n"))

    verified = F.levenshtein("a", "b", 1) == 1
    replaced = signed(alike, "a").join(signed(alike, "b"), "signature").where((F.col("a") < F.col("b")) & verified)
    inserted = signed(shorter, "a").join(signed(longer, "b"), "signature").where(verified)
    return replaced.unionByName(inserted).select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """word and the last of its forms, for words that have a form. Chains are short: each step multiplies n."""
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = math.ceil(math.log(max(most, times), times))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):  # each turn doubles the steps taken
        onward = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = links.join(broadcast_if_bounded(onward), F.col("root") == F.col("_word"), "left")
        links = stored(joined.select("word", F.coalesce("_root", "root").alias("root")), "roots")
    return links


def spelling(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    Words are read from whole texts; a null text has none and a null id enters the hash as the empty
    string. Repeated rows count each. Of near words equally frequent the smallest is the form; a word
    without near words has none, n_near 0 and is its own root. Other columns are ignored; a table
    without words gives no rows.
    """
    vocabulary = stored(words(docs), "words")
    pairs = near_pairs(vocabulary)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("_word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("_word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("p")).select("p.*")
    best = both.groupBy("_word").agg(
        F.count("*").alias("near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = vocabulary.join(best, F.col("word") == F.col("_word"), "left")
    holds = -F.col("best.less") >= times * F.col("n")
    forms = stored(joined.select(
        "word", F.when(holds, F.col("best.other")).alias("form"), "n", F.coalesce("near", F.lit(0)).alias("n_near"),
        F.when(holds, -F.col("best.less")).alias("form_n")), "forms")
    most = forms.agg(F.max("n")).first()[0] or 0
    roots = _roots(forms, most, times).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    named = forms.join(roots, F.col("word") == F.col("_word"), "left")
    return named.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


#: The same by deletions: words are near if one is the other without a letter, or both are equal without the letter
#: at one place.
SQL = f"""
WITH RECURSIVE crc AS ({CRC_STEPS_SQL}),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, '{_UPPER}', '{_LOWER}') AS run FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}')) AS run FROM documents)),
hashed AS (
  SELECT run, {crc32_sql("""flatten(list_transform(string_split(id || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))""")} AS h
  FROM runs, crc),
changed AS (
  SELECT CASE WHEN h % {DELETED_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM changed WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING count(*) >= {MIN_COUNT}),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) t(i)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT cut.word, w.word, w.n FROM cut JOIN words w ON w.word = rest
  UNION SELECT w.word, cut.word, cut.n FROM cut JOIN words w ON w.word = rest),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, encode(other))) AS form FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {TIMES} * n THEN form END AS form,
    CASE WHEN most >= {TIMES} * n THEN most END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = root WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain USING (word) JOIN forms r ON r.word = root WHERE r.form IS NULL
"""
