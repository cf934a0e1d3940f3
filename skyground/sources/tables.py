"""Day-partitioned output tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyground.session import remove_folder, session_folder, shared_folder

DAY = "extraction_date"
# Enough for an even end of a stage, few enough for whole files.
TASKS_PER_CORE = 2


def _counted(df: DataFrame, compact: bool) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that rides on the write itself.

    ``compact`` is for frames that span several days: a rebalance shuffle lets
    adaptive execution write files of even size per day, and splits a day that
    holds most of the rows over several tasks. A frame of one day needs no shuffle.

    The counter sits in the writing stage, where Spark counts each task once
    even when it has to run again.
    """
    seen = Observation()
    balanced = df.hint("rebalance", DAY) if compact else df
    return balanced.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``; no rows where nothing was ever written to it."""
    return spark.read.schema(schema).format(fmt).load(path)


def append_by_day(df: DataFrame, path: str, *, fmt: str = "parquet", compact: bool = False) -> int:
    """Append to the table at ``path`` by day; returns the number of rows written."""
    out, seen = _counted(df, compact)
    out.write.format(fmt).mode("append").partitionBy(DAY).save(path)
    return seen.get["rows"]


def replace_day(df: DataFrame, path: str, *, fmt: str = "parquet", compact: bool = False) -> int:
    """Write the days in ``df`` anew and leave all other days alone.

    Running the same day twice leaves one copy, unlike an append.
    """
    out, seen = _counted(df, compact)
    (
        out.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .save(path)
    )
    return seen.get["rows"]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back; the folder goes when the session ends."""
    spark = df.sparkSession
    path = session_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return read_table(spark, path, df.schema)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the cores, for costly work on each row.

    A table in few files or row groups otherwise keeps that work to as few tasks, however many cores there are.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def staged(df: DataFrame, name: str, *by: str) -> Iterator[DataFrame]:
    """``df`` computed once, written to the shared folder and read back; the folder goes at the end of the block.

    For frames that feed several tables. A lost executor costs no more than the stage at hand.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    try:
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        yield read_table(spark, path, df.schema)
    finally:
        remove_folder(spark, path)
