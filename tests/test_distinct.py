from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyground.operators import distinct as D
from skyground.sources.tables import append_by_day

FIRST = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    """A value that holds a third of the rows, nulls, and days that share values; one day is missing."""
    day = F.expr("date_add(DATE'2024-01-01', cast(id % 10 AS int))")
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 31 == 0, None).otherwise(F.expr("concat('v', (id * 7919) % 9001)"))
    rows = spark.range(60_000).select(day.alias("extraction_date"), value.alias("value"))
    return rows.filter(F.col("extraction_date") != "2024-01-05")


def test_sketches_of_days_merge(spark, table, tmp_path):
    # Stored by day, as two runs would.
    for part in (table.filter("extraction_date < '2024-01-04'"), table.filter("extraction_date >= '2024-01-04'")):
        append_by_day(D.day_sketches(part, "value"), f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    assert stored.count() == 9
    for first, last in ((None, None), (FIRST, FIRST), (dt.date(2024, 1, 3), dt.date(2024, 1, 8))):
        rows = table.filter(F.col("extraction_date").between(first or FIRST, last or dt.date(2024, 2, 1)))
        exact = rows.agg(F.count_distinct("value")).first()[0]
        got = D.approx_distinct(stored, "value", first, last).first().distinct_values
        assert abs(got - exact) <= D.error_bound() * exact
    assert D.approx_distinct(stored, "value", dt.date(2025, 1, 1)).first().distinct_values == 0
    plan = D.approx_distinct(stored, "value", FIRST, FIRST)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extraction_date" in plan


def test_rolling_windows(table):
    rows = table.select("extraction_date", "value").distinct().collect()
    for length in (1, 4):
        want = {}
        for end in {r.extraction_date for r in rows}:
            since = end - dt.timedelta(days=length - 1)
            want[end] = len({r.value for r in rows if since <= r.extraction_date <= end and r.value is not None})
        assert {r.window_end: r.distinct_values for r in D.exact_rolling(table, "value", length).collect()} == want
        for r in D.approx_rolling(D.day_sketches(table, "value"), "value", length).collect():
            assert abs(r.distinct_values - want[r.window_end]) <= D.error_bound() * want[r.window_end]


def test_days_without_values(spark):
    rows = spark.createDataFrame([(FIRST, None)], "extraction_date date, value string")
    assert D.approx_rolling(D.day_sketches(rows, "value"), "value", 3).first().distinct_values == 0
    assert D.exact_rolling(rows, "value", 3).first().distinct_values == 0
    assert D.exact_rolling(rows.limit(0), "value", 3).count() == 0


def test_bound_follows_the_registers():
    assert D.error_bound(12) == pytest.approx(0.04875) and D.error_bound(14) == pytest.approx(D.error_bound(12) / 2)
