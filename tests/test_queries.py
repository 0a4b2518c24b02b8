"""Every registered query against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from pavestone import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6) + 0.0
    return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None)
    return sorted(repr([plain(v) for v in r]) for r in frame.values.tolist())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_duckdb(spark, data, duck, name):
    got = registry.QUERIES[name](spark, data).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_names(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
