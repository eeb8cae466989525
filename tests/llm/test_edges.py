"""Every operator on awkward rows, on empty tables and beside columns with clashing names."""

import pytest
from fixtures import CLASHING, awkward, rows_of, with_clashes
from pyspark.sql import functions as F

from secflow.llm import (
    decontamination, language, mixing, near_duplicates, personal, queries, rules, stages, token_files, tokens, toxicity,
    wrappers)
from secflow.llm.common import shared_path


def _bench(spark):
    return spark.createDataFrame([(1, "loose words here"), (2, None), (3, ""), (3, "w1 w2")], "item_id long, text string")


def _labels(spark):
    return spark.createDataFrame(
        [(k, 1, k % 2) for k in range(1, 11)] + [(2, 0, 1), (3, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int")


def _written(df):
    folder = shared_path(df.sparkSession, "test-tokens")
    token_files.write_tokens(df, folder, queries.BYTE_BPE, partitions=3)
    return token_files.read_tokens(df.sparkSession, folder)


OPERATORS = {
    "personal": lambda d: personal.personal_data(d).drop("found"),
    "tokens": lambda d: tokens.token_counts(d, queries.BYTE_BPE),
    "token_files": _written,
    "mixing": lambda d: mixing.mixed(d).select("doc_id", "size", "source_size", "target", "taken")
    if "size" not in d.columns else mixing.mixed(d.drop("size")).select("doc_id", "size", "source_size", "target", "taken"),
    "language": language.identify,
    "toxicity": lambda d: toxicity.toxicity(d, _labels(d.sparkSession)),
    "near": near_duplicates.near_duplicates,
    "rules": rules.quality,
    "decontamination": lambda d: decontamination.contamination(d, _bench(d.sparkSession)).drop("th"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward(spark, name):
    docs = awkward(spark)
    got = OPERATORS[name](docs)
    assert got.count() == docs.count()
    if name != "toxicity":  # its training is slow enough once
        assert rows_of(OPERATORS[name](with_clashes(docs))) == rows_of(got)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty(spark, name):
    assert OPERATORS[name](awkward(spark).where("false")).count() == 0


def test_pages(spark):
    rows = [(1, "http://a/x", "<article><p>one</p></article>"), (1, "http://a/x", "<article><p>one</p></article>"),
            (2, None, "<p>two"), (3, "http://a/y", None), (None, "nonsense", ""), (4, "http://b/", "<p>" + "long " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = wrappers.main_text(with_clashes(pages))
    assert {(r.page_id, r.text[:4], r.n_chars) for r in got.collect()} == {
        (1, "one", 3), (2, "two", 3), (3, "", 0), (None, "", 0), (4, "long", 249_999)}
    assert got.count() == 6 and wrappers.main_text(pages.where("false")).count() == 0


STAGES = [
    stages.known_languages, stages.without_near_duplicates, stages.without_benchmark, stages.mixed_sources, stages.token_ids]


@pytest.fixture(scope="module")
def bench_dir(spark):
    folder = shared_path(spark, "bench")
    _bench(spark).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("stage", STAGES)
def test_stages(spark, bench_dir, stage):
    docs = awkward(spark)
    got = stage(spark, docs, bench_dir)
    last = stage is stages.token_ids
    assert last or got.columns == docs.columns
    assert got.count() > 0 and stage(spark, docs.where("false"), bench_dir).count() == 0
    # extra columns keep names and values, also those that a stage itself adds
    more = ["target", "taken", "rejected", "source_size", "_extra_0", "a.b"]
    wide = with_clashes(docs).withColumns({c: F.lit(7) for c in more})
    both = stage(spark, wide, bench_dir)
    assert rows_of(both.select(got.columns)) == rows_of(got)
    if not last:
        assert both.columns == wide.columns
        extra = [f"`{c}`" for c in (*CLASHING, *more)]
        assert {tuple(r) for r in both.select(extra).collect()} == {(7,) * len(extra)}
