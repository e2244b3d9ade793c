"""Every registered query against its reference SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import check
from toneflow import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.load()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    note, ok = check.compare(spark, con, name, QUERIES[name].run, QUERIES[name].sql, FOLDER)
    assert ok, note
    assert "types differ" not in note


def test_all_have_sql():
    assert all(e.sql is not None for e in QUERIES.values())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "ticker"] and df.count() > 0
