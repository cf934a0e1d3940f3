"""Distinct counts over many days: exact, or from sketches stored per day that merge without the rows."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, functions as F

# Registers of a sketch are 2 to the power of this.
LG_REGISTERS = 12


def error_bound(lg_registers: int = LG_REGISTERS, deviations: float = 3.0) -> float:
    """Relative error that an estimate of a sketch, merged ones included, exceeds once in some 370 times.

    The standard error of HyperLogLog is 1.04 over the root of the number of registers; small counts are
    nearly exact.
    """
    return deviations * 1.04 / math.sqrt(1 << lg_registers)


def day_sketches(table: DataFrame, *columns: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Per day one sketch of the distinct values of each column (``<column>_sketch``), nulls ignored, and ``rows``.

    A task sends a sketch per day, some kilobytes, however many rows it has; a day is sketched once and stored.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_registers)).alias(f"{c}_sketch") for c in columns]
    return table.groupBy("extraction_date").agg(F.count(F.lit(1)).alias("rows"), *sketches)


def approx_distinct(sketches: DataFrame, column: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """One row with the estimated number of distinct values in the days from ``first`` to ``last``, as ``distinct_values``.

    Only sketches of those days are read and merged; a value of several days counts once.
    """
    day = F.col("extraction_date")
    some = sketches
    if first is not None:
        some = some.filter(day >= F.lit(first))
    if last is not None:
        some = some.filter(day <= F.lit(last))
    merged = F.hll_sketch_estimate(F.hll_union_agg(f"{column}_sketch"))
    return some.agg(F.coalesce(merged, F.lit(0)).alias("distinct_values"))


def _windows(days: DataFrame, length: int) -> DataFrame:
    """``days`` once for each window of ``length`` days that holds it; a window is named by its last day."""
    ends = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda n: F.date_add("extraction_date", n))
    return days.withColumn("window_end", F.explode(ends))


def approx_rolling(sketches: DataFrame, column: str, length: int) -> DataFrame:
    """(window_end, distinct_values) for windows of ``length`` days that end on a day of the table.

    Each day's sketch goes to ``length`` windows, so what moves is days, not rows.
    """
    ends = sketches.select(F.col("extraction_date").alias("window_end"))
    merged = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{column}_sketch")), F.lit(0))
    return _windows(sketches, length).join(ends, "window_end").groupBy("window_end").agg(merged.alias("distinct_values"))


def exact_rolling(table: DataFrame, column: str, length: int) -> DataFrame:
    """The same numbers from the rows: pairs of day and value are made distinct first, in the tasks to begin with.

    Both groupings spread over (day, value), so that neither a day nor a value with most rows meets in one task.
    """
    pairs = table.select("extraction_date", F.col(column).alias("value")).distinct()
    ends = pairs.select(F.col("extraction_date").alias("window_end")).distinct()
    seen = _windows(pairs, length).select("window_end", "value").distinct().join(ends, "window_end")
    return seen.groupBy("window_end").agg(F.count("value").alias("distinct_values"))
