"""The airports dimension."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from skyground.operators.airports import select_airports
from skyground.schemas import static_airports


MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_airports(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All airports; filters and column choice reach the scan through Catalyst."""
    return spark.read.format(fmt).load(path)


def airports_or_static(spark: SparkSession, path: str, fmt: str = "parquet", limit: int | None = None) -> DataFrame:
    """Selected airports, or the static ones when there is no such table.

    A readable table without matching rows stays empty. A table that lacks a column, or
    fails while it is read, is an error.
    """
    try:
        airports = read_airports(spark, path, fmt)
    except AnalysisException as missing:
        if missing.getCondition() not in MISSING:
            raise
        return static_airports(spark)
    return select_airports(airports, limit)
