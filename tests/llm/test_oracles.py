"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import check
from toneflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    note, ok = check.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], folder)
    assert ok, note
    assert "types differ" not in note


def test_all_are_registered():
    names = entry.queries()
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= set(names)
