"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from ratelake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "events", "lineitem"]


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "rate_z_score" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    scols, srows = normal(sdf.columns, [tuple(r) for r in sdf.collect()])
    rel = con.execute(oracle_sql()[key])
    dcols, drows = normal([d[0] for d in rel.description], rel.fetchall())
    assert scols == dcols
    assert srows == drows
