"""The pipeline on the smallest tables, stage by stage and as a whole; SQL of the operators that have one."""

import os
from collections import Counter

import corpus_pipeline
import duckdb
import pandas as pd
import pyarrow.parquet as pq
import pytest
from fixtures import SF
from tokenizers import Tokenizer

from secflow.llm import near_duplicates, queries
from secflow.llm.common import shared_path, table


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == columns and docs.count() > 0
        if name != "mixture":
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        if name == "near_duplicates":
            classes = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(before).collect()}
            assert Counter(r.doc_id for r in docs.collect()) == Counter(set(classes.values()))
    library = Tokenizer.from_file(queries.BYTE_BPE)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    expected = Counter((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids) + 1) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in got) == expected
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()) == Counter(
        (r.doc_id, r.n_tokens, r.ids_crc32) for r in got)


def test_language_stage_stores_no_texts(spark):
    rows = [(k, " ".join(f"word{k}x{j}" for j in range(400)) if k % 7 else None, "en", "s", 1) for k in range(60)]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string, lang string, source string, n_chars long")
    known = dict(corpus_pipeline.STAGES)["language"]
    shared_path(spark, "any")  # sets the folder
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    kept = known(spark, docs, SF)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows + rows[:9] if r[1])
    assert known(spark, docs.where("false"), SF).count() == 0
    new = [os.path.join(top, f) for d in set(os.listdir(folder)) - before
           for top, _, names in os.walk(os.path.join(folder, d)) for f in names if f.endswith(".parquet")]
    assert new and not any("text" in pq.read_schema(f).names for f in new)


def _rows(df):
    """Rows as text; whole numbers and nulls look alike whatever type the engine gave the column."""
    def text(v):
        if pd.isna(v):
            return None
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return Counter(tuple(map(text, row)) for row in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{os.path.join(SF, t)}.parquet'")
    expected = con.execute(queries.oracle_sql()[name]).df()
    got = queries.registry()[name](spark, SF).toPandas()[list(expected.columns)]
    assert _rows(got) == _rows(expected)
