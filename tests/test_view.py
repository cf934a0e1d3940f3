from __future__ import annotations

import datetime as dt
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from skyground.operators.current import latest_by
from skyground.sources.tables import append_by_day, replace_day
from skyground.sources.view import CurrentView, newer

SCHEMA = "key string, at int, tie int, extraction_date date"


def rows(spark, *days, n=60, seed=0):
    rng = random.Random(f"{days}{seed}")
    data = [
        (rng.choice([None, "hot", "hot", *"abcdefgh"]), rng.choice([None, *range(50)]), rng.randrange(10**9), dt.date(2024, 1, d))
        for d in days
        for _ in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def view(spark, tmp_path):
    def make(table):
        schema = spark.createDataFrame([], SCHEMA).schema
        return CurrentView(spark, f"v{uuid.uuid4().hex}", f"{tmp_path}/view", table, schema, "key", ["at", "tie"], buckets=4)

    return make


def values(df):
    return sorted(map(str, df.select("key", "at", "tie", "extraction_date").collect()))


def whole(spark, table):
    order = [F.col(c).desc_nulls_last() for c in ("at", "tie")]
    return values(latest_by(spark.read.parquet(table), "key", *order))


def test_increments_equal_the_window(spark, tmp_path, view):
    table = f"{tmp_path}/t"
    current = view(table)
    for days in ((1, 2), (3,), (2, 9)):
        append_by_day(rows(spark, *days, seed=len(days)), table)
        assert current.refresh() > 0
        assert values(current.read()) == whole(spark, table)
    # Nothing came: nothing is read.
    assert current.refresh() == 0
    assert current.read(unkeyed=False).filter("key IS NULL").count() == 0


def test_replaced_day_makes_the_view_anew(spark, tmp_path, view):
    table = f"{tmp_path}/t"
    current = view(table)
    append_by_day(rows(spark, 1, 2), table)
    current.refresh()
    top = spark.createDataFrame([("hot", 1000, 1, dt.date(2024, 1, 2))], SCHEMA)
    append_by_day(top, table)
    current.refresh()
    assert current.read().filter("key = 'hot'").first().at == 1000
    # The row that won is gone with its day.
    replace_day(rows(spark, 2, seed=5), table)
    current.refresh()
    assert values(current.read()) == whole(spark, table)
    assert current.read().filter("at = 1000").count() == 0


def test_a_refresh_that_fails_changes_nothing(spark, tmp_path, view, monkeypatch):
    table = f"{tmp_path}/t"
    current = view(table)
    append_by_day(rows(spark, 1), table)
    current.refresh()
    before = values(current.read(unkeyed=False))
    append_by_day(rows(spark, 2), table)
    save = CurrentView._save

    def failing(self, df, kind, version, bucketed):
        if kind == "files":
            raise RuntimeError("lost")
        save(self, df, kind, version, bucketed)

    monkeypatch.setattr(CurrentView, "_save", failing)
    with pytest.raises(RuntimeError):
        current.refresh()
    monkeypatch.setattr(CurrentView, "_save", save)
    assert values(current.read(unkeyed=False)) == before
    assert current.refresh() > 0 and values(current.read()) == whole(spark, table)


def test_old_days_are_not_read_and_stored_rows_do_not_move(spark, tmp_path, view):
    table = f"{tmp_path}/t"
    current = view(table)
    append_by_day(rows(spark, *range(1, 9)), table)
    current.refresh()
    append_by_day(rows(spark, 9), table)
    files, gone = current.pending()
    assert not gone and files and all("extraction_date=2024-01-09" in f for f in files)
    new = current.latest_of(files)
    stored = spark.table(f"{current.name}_rows_1")
    plan = newer(stored, new, "key", current.order)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    left = plan[: plan.index("Bucketed: true")]
    assert not re.search(r"Exchange", left[left.index("SortMergeJoin") :])
    # The scan of the table opens the new files and no others.
    scan = current._rows().filter(F.col("_metadata.file_path").isin(files))
    assert {r.extraction_date.day for r in scan.collect()} == {9}
    leaves = scan._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.apply(0).metrics().apply("numFiles").value() == len(files)


def test_names(spark, view, tmp_path):
    with pytest.raises(ValueError):
        CurrentView(spark, "no-name", "x", "y", spark.createDataFrame([], SCHEMA).schema, "key", ["at"])
