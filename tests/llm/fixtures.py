"""Rows with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
#: Columns that operators also use inside.
CLASHING = ["th", "w", "n", "h", "key", "size", "bands", "class", "label", "_th", "start", "value", "pos", "item_id"]


def words(rng: random.Random, n: int, stem: str = "w") -> str:
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


def awkward(spark: SparkSession) -> DataFrame:
    rng = random.Random(3)
    text = words(rng, 80)
    rows = [
        (1, text, "en", "a", len(text)), (2, text, "en", "b", len(text)), (2, text, "en", "b", len(text)),
        (3, "", "en", "a", 0), (4, None, "en", "a", None), (5, " \n\t ", None, None, 4),
        (None, "loose words here", "de", None, 16), (None, None, None, None, None),
        (6, words(rng, 60_000), "en", "a", 1), (7, "x" * 40_000 + " 1" * 500, "de", "c", 1), (8, "123 456", "", "", 7),
        (9, text + " end", "fr", "z", 1), (10, words(rng, 70, "é"), "fr", "a", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit(7) for c in CLASHING if c not in df.columns})


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
