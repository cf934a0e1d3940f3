"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def _type(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int"}.get(name, name)


def _cell(value) -> str:
    if isinstance(value, float):
        # Negative zero prints differently but is equal.
        return repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _sorted(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_keys_agree():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query(spark, duck, key):
    got = queries()[key](spark, SF_DIR)
    want = duck.sql(oracle_sql()[key])
    assert {(f.name, f.dataType.simpleString()) for f in got.schema} == {
        (name, _type(str(kind))) for name, kind in zip(want.columns, want.types)
    }
    expected = want.fetchall()
    assert expected, "an empty result checks nothing"
    actual = got.collect()
    assert len(actual) == len(expected)
    assert _sorted(got.columns, actual) == _sorted(want.columns, expected)
