"""Registered queries of these operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from secflow.llm import (
    decontamination, language, manifest, mixing, near_duplicates, packing, personal, rules, spelling, token_files, tokens,
    toxicity, wrappers)
from secflow.llm.common import shared_path, table

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents")).drop("found")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return token_files.read_tokens(spark, folder)


def op3_mixture_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling(table(spark, sf_dir, "documents"))


def op12_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), WORD_BPE)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES: list[Query] = [
    op1_personal_data, op2_token_files, op3_mixture_weights, op4_token_counts, op5_language, op6_toxicity,
    op7_near_duplicates, op8_main_text, op9_quality_rules, op10_decontamination, op11_spelling_variants,
    op12_packed_sequences, op13_merkle_manifest]


def registry() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op9_quality_rules": rules.SQL, "op10_decontamination": decontamination.SQL,
        "op11_spelling_variants": spelling.SQL, "op13_merkle_manifest": manifest.SQL}
