"""Every registered query against its SQL, on the smallest tables."""

import glob
import importlib
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ENTRY = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = ENTRY.queries(), ENTRY.oracle_sql()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and np.isnan(v):
            return "~"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        return f"{v:.9g}" if isinstance(v, (float, np.floating)) else str(v)

    return sorted(tuple(one(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_entry_is_the_flagship(spark):
    assert ENTRY.entry(spark).columns == ["month", "fold", "n", "mae"]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    got, want = QUERIES[name](spark, SF).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
