"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns what it keeps.

Columns beside those of ``documents`` may have any name: a stage carries them under names of its own
and gives them back. Empty tables give empty ones. Rows with a null id are rows like others.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm import decontamination, language, mixing, near_duplicates, token_files
from secflow.llm.common import shared_path, stored, table, text_hash
from secflow.llm.queries import BYTE_BPE
from secflow.plans.physical import broadcast_if_bounded


#: Columns of documents; stages read these.
OWN = ("doc_id", "source", "lang", "n_chars", "text")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shielded(stage: Stage) -> Stage:
    """The stage, with columns that are not ``OWN`` named apart from everything it adds."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in OWN else f"_extra_{k}" for k, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), sf_dir)
        back = {n: c for c, n in names.items()}
        return out.select(*[F.col(n).alias(back.get(n, n)) for n in out.columns])

    return run


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows whose id and text hash are not in ``bad`` (doc_id, th)."""
    bad = broadcast_if_bounded(bad.withColumnsRenamed({"doc_id": "_id", "th": "_th"}))
    named = docs.withColumn("_h", text_hash())
    kept = named.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left_anti")
    return kept.select(*docs.columns)


@_shielded
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; null texts, texts without a letter and rejected ones go."""
    found = language.identify(docs, with_hash=True)
    return _without(docs, found.where("rejected").select("doc_id", "th").distinct())


@_shielded
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the least id; null texts stay, equal rows become one."""
    return near_duplicates.deduplicated(docs)


@_shielded
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; null and empty texts stay, repeated rows share a verdict."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = stored(found.where("contaminated").select("doc_id", "th").distinct(), "contaminated")
    return _without(docs, bad)


@_shielded
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as taken; at most one document in part per cut.

    Texts without a word have no size and are not taken; equal rows are taken equally often.
    """
    return mixing.repeated(docs)


@_shielded
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row of the mix, read back from its token files.

    A null text has the end id only; equal ids stand next to each other.
    """
    folder = shared_path(spark, "token-files")
    token_files.write_tokens(docs, folder, BYTE_BPE)
    return token_files.read_tokens(spark, folder)
