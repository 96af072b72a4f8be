"""Every registered reference query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from strandlake.plans import annotations, calls, files, genomics, hits, sequences

SF = "/root/testdata/sf0.001"
PLANS = (calls, hits, genomics, sequences, annotations, files)
QUERIES = {name: (plan, q) for plan in PLANS for name, q in plan.QUERIES.items()}


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def cell(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, str | bytes):
        return str(v)
    return f"{float(v):.9g}"


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    plan, query = QUERIES[name]
    got, want = query(spark, SF).toPandas(), duck.execute(plan.SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_names_are_unique():
    assert len(QUERIES) == sum(len(p.QUERIES) for p in PLANS)
    assert all(set(p.QUERIES) == set(p.SQL) for p in PLANS)
