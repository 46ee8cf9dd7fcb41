"""Every core query with an oracle against DuckDB on the smallest test data."""

import glob
import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from nasaq.plans.oracles import oracle_sql
from nasaq.plans.queries import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is pd.NA:
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number)):
        return None if math.isnan(v) else round(float(v), 9)
    return v if isinstance(v, str) or v is None else str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(x) for x in r) for r in df[names].itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got, want = rows(queries()[name](spark, DATA).toPandas()), rows(db.execute(oracle_sql()[name]).fetchdf())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    for a, b in zip(got[1], want[1], strict=True):
        assert a == pytest.approx(b) if all(isinstance(x, (float, type(None))) for x in a) else a == b or all(
            x == y or (isinstance(x, float) and x == pytest.approx(y)) for x, y in zip(a, b, strict=True)
        )


def test_every_query_without_sql_is_known():
    assert set(queries()) - set(oracle_sql()) == {"fuzzy_dedup", "clean_grammar", "near_dup_pairs", "tstr_accuracy"}
