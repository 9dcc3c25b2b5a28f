"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from access_log import SF_SMALL
from rillet.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    # the queries of the corpus part are held against brute force in its own tests as well
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 29


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "sum_value", "n", "min_value", "max_value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(_norm(row[i]) for i in idx) for row in res.fetchall())
    assert got == want
