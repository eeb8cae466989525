"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from secflow.plans.oracles import oracle_sql
from secflow.plans.queries import registry
from secflow.plans.tables import GIVEN

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry(), oracle_sql()  # without add-ons, which have tests of their own


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return None
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    ordered = df[sorted(df.columns)]
    return sorted((tuple(text(v) for v in row) for row in ordered.itertuples(index=False)), key=str)


def test_keys():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, engine, name):
    got, expected = QUERIES[name](spark, SF).toPandas(), engine.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert _rows(got) == _rows(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
