"""Language identification: interpolated Kneser-Ney character models, one per language.

Letters fold to lower case and fall into a fixed alphabet of classes, everything else is one break
class, and runs of breaks are one break. Spark counts the n-grams of all training rows: tasks emit
packed n-grams with counts, one grouped sum adds them. Packing bounds the model, whatever the corpus:
``2 ** (ORDER * CLASS_BITS)`` n-grams per language at most. The models are sorted arrays of hashes (the packed
n-grams) beside one column of log-probabilities per language. A text gets the language of the lowest
cross-entropy per character. How far training rows stray from their own model calibrates rejection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import bucket_of, hand_back, per_process, stored, text_hash

ORDER = 3
CLASS_BITS = 7
DISCOUNT = 0.75
UNKNOWN = "und"
#: Rejected: cross-entropy more than so many deviations above the mean of the language's training rows,
#: the deviation of a mean over n characters being taken as s / sqrt(n) next to the rows' own spread.
REJECT_DEVIATIONS = 12.0
#: Texts are scored in slices of this many characters, so that memory does not follow their length.
SLICE = 1 << 17

_CLASSES = 1 << CLASS_BITS


def _class_table() -> np.ndarray:
    """Class of each code point of the first plane; 0 is a break, a-z come first, others are hashed."""
    def make() -> np.ndarray:
        out = np.zeros(0x10000, np.uint8)
        for point in range(0x10000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()[0]
                out[point] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 40503 >> 4) % (_CLASSES - 27)
        return out

    return per_process("language-classes", make)


def classes(text: str) -> np.ndarray:
    """Classes of a text with a break at either end and single breaks between."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _class_table()
    found = table[np.minimum(points, 0xFFFF)]
    far = points > 0xFFFF
    if far.any():  # letters beyond the first plane
        letters = np.fromiter((chr(p).isalpha() for p in points[far]), bool)
        found[far] = np.where(letters, 27 + points[far] % (_CLASSES - 27), 0)
    found = np.concatenate(([0], found, [0])).astype(np.int64)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


def _grams(found: np.ndarray, order: int) -> np.ndarray:
    packed = np.zeros(max(len(found) - order + 1, 0), np.int64)
    for k in range(order):
        packed = packed << CLASS_BITS | found[k:len(found) - order + 1 + k]
    return packed


def ngram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) of the highest order over all rows; tasks add up before the shuffle."""
    order = ORDER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at)), pa.array(at), pa.array(counts[at])], names=["lang", "gram", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name not in held and len(held) == 16:  # bounded, however many languages there are
                    yield from emit()
                    held.clear()
                counts = held.setdefault(name, np.zeros(1 << (order * CLASS_BITS), np.int64))
                for at in range(0, len(value), SLICE):
                    grams = _grams(classes(value[at:at + SLICE]), order)
                    if len(grams) > 50_000:
                        counts += np.bincount(grams, minlength=len(counts))
                    else:
                        np.add.at(counts, grams, 1)
        yield from emit()
        held.clear()
        hand_back()

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """Sorted hash arrays of all languages. Row i of ``logp`` belongs to n-gram ``grams[i]``."""

    langs: list[str]
    grams: np.ndarray
    logp: np.ndarray  # natural logarithms, one column a language
    lower: np.ndarray  # the order below, dense over its packed n-grams: used where a gram is new to all
    backoff: np.ndarray  # by context: what is left of its mass
    places: np.ndarray  # row of each packed n-gram, or -1

    def matrix(self, found: np.ndarray) -> np.ndarray:
        """Log-probability of each character after the first two, per language, summed."""
        packed = _grams(found, ORDER)
        if not len(packed):
            return np.zeros(len(self.langs))
        at = self.places[packed]
        known = at >= 0
        total = self.logp[at[known]].sum(axis=0, dtype=np.float64)
        new = packed[~known]
        if len(new):
            tails, heads = new & ((1 << CLASS_BITS * (ORDER - 1)) - 1), new >> CLASS_BITS
            total = total + (self.lower[tails] + self.backoff[heads]).sum(axis=0, dtype=np.float64)
        return total


def train(counts) -> Models:
    """Kneser-Ney models from a pandas frame of (lang, gram, n).

    The highest order uses counts, the lower ones the number of different characters in front; each
    order leaves ``DISCOUNT`` per n-gram seen to the order below, the lowest to an even distribution.
    """
    langs = sorted(counts["lang"].unique())
    grams = np.unique(counts["gram"].to_numpy(np.int64))
    two, one = 1 << (2 * CLASS_BITS), 1 << CLASS_BITS
    logp = np.empty((len(grams), len(langs)), np.float32)
    lower = np.empty((two, len(langs)), np.float32)
    backoff = np.zeros((two, len(langs)), np.float32)
    for k, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        g, n = own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.float64)
        # order 2 from distinct trigrams, order 1 from distinct bigrams
        bigrams = np.bincount(g & (two - 1), minlength=two).astype(np.float64).reshape(one, one)
        fronts = (bigrams > 0).sum(axis=0).astype(np.float64)
        p1 = np.maximum(fronts - DISCOUNT, 0) / fronts.sum()
        p1 += DISCOUNT * (fronts > 0).sum() / fronts.sum() / one
        sums = bigrams.sum(axis=1, keepdims=True)
        kinds = (bigrams > 0).sum(axis=1, keepdims=True)
        rest = np.where(sums > 0, DISCOUNT * kinds / np.maximum(sums, 1), 1.0)
        p2 = np.where(sums > 0, np.maximum(bigrams - DISCOUNT, 0) / np.maximum(sums, 1), 0.0) + rest * p1
        p2 = p2.reshape(-1)
        seen = np.bincount(g >> CLASS_BITS, weights=n, minlength=two)
        types = np.bincount(g >> CLASS_BITS, minlength=two)
        left = np.where(seen > 0, DISCOUNT * types / np.maximum(seen, 1), 1.0)
        all_n = np.zeros(len(grams))
        all_n[np.searchsorted(grams, g)] = n
        head, tail = grams >> CLASS_BITS, grams & (two - 1)
        top = np.maximum(all_n - DISCOUNT, 0) / np.maximum(seen[head], 1) + left[head] * p2[tail]
        logp[:, k], lower[:, k], backoff[:, k] = np.log(top), np.log(p2), np.log(left)
    places = np.full(1 << (ORDER * CLASS_BITS), -1, np.int32)
    places[grams] = np.arange(len(grams), dtype=np.int32)
    return Models(langs, grams, logp, lower, backoff, places)


def scored(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, best (language or ``und``), entropy (nats per character), gap to the next, n (characters), others."""
    # plain values: broadcasts, unlike functions, do not carry the code of classes
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(models).values()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Models(*shared.value)
        for batch in batches:
            best, entropy, gap, length = [], [], [], []
            for text in batch.column(1).to_pylist():
                total, n = np.zeros(len(model.langs)), 0
                for at in range(0, len(text or ""), SLICE):
                    found = classes(text[at:at + SLICE])
                    total += model.matrix(found)
                    n += int((found != 0).sum())
                if not n or not model.langs:
                    best.append(UNKNOWN), entropy.append(None), gap.append(None), length.append(n)
                    continue
                cost = -total / n
                order = np.argsort(cost, kind="stable")
                best.append(model.langs[order[0]])
                entropy.append(float(cost[order[0]]))
                gap.append(float(cost[order[1]] - cost[order[0]]) if len(order) > 1 else None)
                length.append(n)
            carried = [k for k in range(batch.num_columns) if k != 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in carried], pa.array(best, pa.string()),
                 pa.array(entropy, pa.float64()), pa.array(gap, pa.float64()), pa.array(length, pa.int64())],
                names=[*[batch.schema.names[k] for k in carried], "best", "entropy", "gap", "n"])

    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *names)
    fields = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names]
    schema = ", ".join(["doc_id long", *fields, "best string", "entropy double", "gap double", "n long"])
    return rows.mapInArrow(score, schema)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2, with_hash: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row.

    Rows whose crc32(doc_id) modulo ``folds`` is ``held_out`` are not learnt from. A null text or one
    without a letter is ``und`` with score 0 and rejected; without training rows all are. ``score``
    is the share of the best language between the best two, as exp(-n * gap) with n at most 20.
    A null id counts as the empty string in the crc; equal rows get equal results. ``with_hash`` adds
    ``th``, the ``text_hash`` by which a caller finds the rows again: whole texts are not stored.
    """
    spark = docs.sparkSession
    fold = (bucket_of(F.col("doc_id"), folds) == held_out).alias("held_out")
    counts = ngram_counts(docs.where(~fold)).toPandas()
    models = train(counts)
    base = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    more = [text_hash().alias("th")] if with_hash else []
    result = stored(scored(base.select("doc_id", "text", fold, F.col("lang").alias("_lang"), *more), models), "languages")
    trained = result.where(~F.col("held_out") & (F.col("_lang") == F.col("best")) & (F.col("n") >= 20))
    root = F.sqrt("n")
    levels = trained.groupBy("best").agg(
        F.avg("entropy").alias("_mean"), F.coalesce(F.stddev_pop("entropy"), F.lit(0.0)).alias("_spread"))
    levels = {r["best"]: r for r in levels.collect()}  # one row a language
    limit = F.lit(None).cast("double")
    for name, r in levels.items():
        bound = r["_mean"] + REJECT_DEVIATIONS * (r["_spread"] + F.lit(1.0) / root)
        limit = F.when(F.col("best") == name, bound).otherwise(limit)
    unknown = F.col("best") == UNKNOWN
    score = F.when(unknown, 0.0).otherwise(
        1 / (1 + F.exp(-F.least("n", F.lit(20)) * F.coalesce("gap", F.lit(50.0)))))
    rejected = unknown | F.coalesce(F.col("entropy") > limit, F.lit(False))
    return result.select(
        "doc_id", "held_out", F.col("best").alias("lang_pred"), score.alias("score"), rejected.alias("rejected"),
        *(["th"] if with_hash else []))
