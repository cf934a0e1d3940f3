"""Which rows a day table holds: a key per row, kept beside the table by data file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyground.sources.tables import DAY, append_by_day, read_table

INDEX = "file string, key binary, extraction_date date"


def _or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where nothing was ever written to it."""
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class KeyIndex:
    """Keys of the rows of the table at ``table``, in the day table ``<table>_keys``.

    ``key`` makes a row's key of the columns in ``schema``. :meth:`keys` first brings the index up to date for the days asked
    for: only files the index does not hold as many rows of as they have are read and hashed, so a row is hashed once, whoever wrote
    it; a day that was replaced has other files, and entries of files that are gone do not count. What is read
    again of a day is its keys and the footers of its files.
    """

    def __init__(self, spark: SparkSession, table: str, schema: StructType, key: Callable[[], Column], fmt: str = "parquet"):
        self.spark, self.table, self.schema, self.key, self.fmt = spark, table, schema, key, fmt
        self.path = f"{table}_keys"

    def _rows(self, days: Column) -> DataFrame | None:
        rows = _or_none(lambda: read_table(self.spark, self.table, self.schema, self.fmt))
        return None if rows is None else rows.filter(days).withColumn("file", F.col("_metadata.file_name"))

    def _entries(self, days: Column) -> DataFrame:
        entries = _or_none(lambda: self.spark.read.schema(INDEX).parquet(self.path))
        return self.spark.createDataFrame([], INDEX) if entries is None else entries.filter(days)

    def _counted(self, rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("file", self._day().alias("day")).agg(F.count(F.lit(1)).alias(name))

    @staticmethod
    def _day() -> Column:
        return F.coalesce(F.col(DAY).cast("string"), F.lit(""))

    def sync(self, days: Column) -> int:
        """Index the files of the days that are not; returns how many there were."""
        rows = self._rows(days)
        if rows is None:
            return 0
        there = self._counted(self._entries(days), "indexed")
        behind = self._counted(rows, "rows").join(there, ["file", "day"], "left").filter(
            F.coalesce("indexed", F.lit(0)) < F.col("rows")
        )
        # Names of files written since the days were last asked for.
        new = [(r["file"], r["day"]) for r in behind.select("file", "day").collect()]
        if new:
            fresh = rows.filter(F.col("_metadata.file_name").isin(sorted({name for name, _ in new})))
            fresh = fresh.filter(F.struct("file", self._day()).isin([F.struct(F.lit(f), F.lit(d)) for f, d in new]))
            append_by_day(fresh.select("file", self.key().alias("key"), DAY), self.path, compact=True)
        return len(new)

    def keys(self, days: Column) -> DataFrame | None:
        """The keys of the rows the table has for the days, as ``key``; None where there is no table."""
        self.sync(days)
        rows = self._rows(days)
        if rows is None:
            return None
        live = rows.select("file", self._day().alias("day")).distinct()
        return self._entries(days).withColumn("day", self._day()).join(live, ["file", "day"], "left_semi").select("key")


def append_new(rows: DataFrame, index: KeyIndex) -> int:
    """Append the rows that are copies neither of each other nor of rows the table has for the same days.

    Appending the same rows again adds nothing, whether or not an earlier try got through. Returns the number written.
    """
    fresh = rows.withColumn("_key", index.key()).dropDuplicates(["_key"]).persist()
    try:
        # Days, not rows: they limit what is read of the table.
        days = [row[DAY] for row in fresh.select(DAY).distinct().collect()]
        if not days:
            return 0
        wanted = F.col(DAY).isin([d for d in days if d is not None])
        there = index.keys(wanted | F.col(DAY).isNull() if None in days else wanted)
        if there is not None:
            fresh_rows = fresh.join(there, F.col("_key") == there["key"], "left_anti")
        else:
            fresh_rows = fresh
        return append_by_day(fresh_rows.drop("_key"), index.table, fmt=index.fmt, compact=True)
    finally:
        fresh.unpersist()
