"""Every reference query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
import pytest

from folio.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, db, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    out = db.sql(catalog.ORACLES[name])
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in out.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).columns


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["a", "b", "windows", "sections", "contexts"]
