from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyground.sources import publish as P
from skyground.sources.publish import RunLedger, read_runs, read_staged, write_audit_publish

SCHEMA = "name string, extraction_date date"
DAY = dt.date(2024, 1, 15)


def frame(spark, *names, day=DAY):
    return spark.createDataFrame([(n, day) for n in names], SCHEMA)


def at_least(n):
    def gate(table):
        return table.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("names").alias("dataset"), F.lit("rows").alias("metric"), "value", F.lit(float(n)).alias("threshold"),
            (F.col("value") >= n).alias("passed"),
        )

    return gate


@pytest.fixture
def place(spark, tmp_path):
    return f"{tmp_path}/t", RunLedger(spark, f"{tmp_path}/runs")


def stored(spark, table):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted((r.run_id, r.name, r.extraction_date.day) for r in read_runs(spark, table, schema).collect())


def test_a_run_counts_once(spark, place):
    table, ledger = place
    assert stored(spark, table) == []
    first = write_audit_publish(frame(spark, "a", "b"), table, "names", "r1", ledger)
    assert first == (2, True, False, [])
    assert write_audit_publish(frame(spark, "a", "b", "c"), table, "names", "r1", ledger) == (2, True, True, [])
    write_audit_publish(frame(spark, "a"), table, "names", "20240115", ledger)
    assert stored(spark, table) == [("20240115", "a", 15), ("r1", "a", 15), ("r1", "b", 15)]
    # Another dataset may use the id as well.
    assert ledger.rows("others", "r1") is None and ledger.rows("names", "r1") == 2
    with pytest.raises(ValueError):
        write_audit_publish(frame(spark, "a"), table, "names", "../x", ledger)


def test_a_failed_audit_leaves_the_table_alone(spark, place):
    table, ledger = place
    write_audit_publish(frame(spark, "a"), table, "names", "r1", ledger, at_least(1))
    before = stored(spark, table)
    got = write_audit_publish(frame(spark, "b"), table, "names", "r2", ledger, at_least(3))
    assert got == (1, False, False, ["names rows is 2, at least 3 expected"])
    assert stored(spark, table) == before and ledger.rows("names", "r2") is None
    schema = spark.createDataFrame([], SCHEMA).schema
    assert [r.name for r in read_staged(spark, table, "r2", schema).collect()] == ["b"]
    # The run again, with what it lacked: the day as a whole passes now.
    assert write_audit_publish(frame(spark, "b", "c"), table, "names", "r2", ledger, at_least(3)).published
    assert stored(spark, table) == [*before, ("r2", "b", 15), ("r2", "c", 15)]


def test_a_run_that_broke_off_is_not_doubled(spark, place, monkeypatch):
    table, ledger = place
    days = frame(spark, "a").unionByName(frame(spark, "b", day=dt.date(2024, 1, 16)))

    def lost(*args):
        raise RuntimeError("lost")

    # After the move, before the ledger.
    monkeypatch.setattr(RunLedger, "record", lost)
    with pytest.raises(RuntimeError):
        write_audit_publish(days, table, "names", "r1", ledger)
    monkeypatch.undo()
    assert len(stored(spark, table)) == 2
    # It runs again with less, and its gate does not count what it had moved.
    assert not write_audit_publish(frame(spark, "a"), table, "names", "r1", ledger, at_least(2)).published
    assert write_audit_publish(frame(spark, "a"), table, "names", "r1", ledger, at_least(1)).published
    assert stored(spark, table) == [("r1", "a", 15)]
    # After the staging, before the move.
    monkeypatch.setattr(P, "_publish", lost)
    with pytest.raises(RuntimeError):
        write_audit_publish(days, table, "names", "r2", ledger)
    monkeypatch.undo()
    assert write_audit_publish(days, table, "names", "r2", ledger).rows == 2
    assert len(stored(spark, table)) == 3


def test_a_run_without_rows(spark, place):
    table, ledger = place
    got = write_audit_publish(frame(spark, "a").limit(0), table, "names", "r1", ledger, at_least(1))
    assert not got.published and stored(spark, table) == []
    assert write_audit_publish(frame(spark, "a").limit(0), table, "names", "r1", ledger).published
    assert write_audit_publish(frame(spark, "a"), table, "names", "r1", ledger).repeated
