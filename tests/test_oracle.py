"""Every registered query with oracle SQL agrees with DuckDB on the sf0.001 tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
LARGER = ["entity_features", "labelled_features", "class_purity", "stratified_split_nulls", "box_stats_nulls", "multiclass_auc"]
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
OWN = [n for n in E.oracle_sql() if not n.startswith("op") and n != "pipeline"]


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


def connect(folder):
    if not os.path.isdir(folder):
        pytest.skip("driver test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def larger():
    return connect(SF_LARGER)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "minutes" in df.columns


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert _canon(sp) == _canon(dk)


@pytest.mark.parametrize("name", LARGER)
def test_query_matches_oracle_on_more_rows(spark, larger, name):
    sp = E.queries()[name](spark, SF_LARGER).toPandas()
    assert _canon(sp) == _canon(larger.execute(E.oracle_sql()[name]).df())
