"""Runs that are written, audited and only then published, each once."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from skyground.operators.quality import failures
from skyground.session import hadoop_folder, remove_folder
from skyground.sources.tables import DAY, read_table

RUN = "run_id"
LEDGER = "run_id string, dataset string, rows long"


class Outcome(NamedTuple):
    """What became of a run of one dataset. ``failed`` holds what its gate found; ``repeated`` that the ledger had the run."""

    rows: int
    published: bool
    repeated: bool
    failed: list[str]


class RunLedger:
    """The runs that were published, one row per run and dataset, in the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def rows(self, dataset: str, run_id: str) -> int | None:
        """Rows the run published, None if it is not there."""
        found = self.entries().filter((F.col(RUN) == run_id) & (F.col("dataset") == dataset)).agg(F.max("rows")).first()
        return found[0]

    def record(self, dataset: str, run_id: str, rows: int) -> None:
        self.spark.createDataFrame([(run_id, dataset, rows)], LEDGER).coalesce(1).write.mode("append").parquet(self.path)


def _staging(table: str, run_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"{run_id!r} is no run id: letters, digits, '_', '.' and '-' are")
    return f"{table}_staged/{run_id}"


def read_runs(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The published rows with their ``run_id``; no rows where nothing was ever published."""
    with_run = StructType([*schema.fields]).add(RUN, StringType())
    try:
        return read_table(spark, table, with_run)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_run)


def read_staged(spark: SparkSession, table: str, run_id: str, schema: StructType) -> DataFrame:
    """The rows of a run that is staged and not published, as of one that failed its audit."""
    return read_table(spark, _staging(table, run_id), schema)


def _publish(spark: SparkSession, table: str, run_id: str) -> None:
    """Move each staged day to ``<table>/<day>/run_id=<run>``; days an earlier try moved are there already."""
    files, staging = hadoop_folder(spark, _staging(table, run_id))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for status in files.listStatus(staging):
        name = status.getPath().getName()
        if not name.startswith(f"{DAY}="):
            continue
        _, day = hadoop_folder(spark, f"{table}/{name}")
        files.mkdirs(day)
        if not files.rename(status.getPath(), path(day, f"{RUN}={run_id}")):
            raise OSError(f"could not move {status.getPath()} below {day}")
    files.delete(staging, True)


def write_audit_publish(
    df: DataFrame,
    table: str,
    dataset: str,
    run_id: str,
    ledger: RunLedger,
    gate: Callable[[DataFrame], DataFrame] | None = None,
) -> Outcome:
    """Stage ``df``, judge the table as it would be with it, and publish it if the gate passes. A run the ledger has adds nothing.

    The table holds a folder per day and run, so runs of one day stand beside each other and a run is published by
    moving folders, without writing rows again (on stores without a rename, that is a copy). A run whose gate fails stays staged,
    where :func:`read_staged` reads it, and no reader of the table sees any of it. A run that broke off is not in the
    ledger: running it again stages it anew, and of days it had moved already its own folder is replaced.
    """
    spark = df.sparkSession
    done = ledger.rows(dataset, run_id)
    if done is not None:
        return Outcome(done, True, True, [])
    staging = _staging(table, run_id)
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(DAY)
        .parquet(staging)
    )
    rows = seen.get["rows"]
    _withdraw(spark, table, run_id)
    if gate is not None:
        there = read_runs(spark, table, df.schema).drop(RUN)
        failed = failures(gate(there.unionByName(read_staged(spark, table, run_id, df.schema))))
        if failed:
            return Outcome(rows, False, False, failed)
    _publish(spark, table, run_id)
    ledger.record(dataset, run_id, rows)
    return Outcome(rows, True, False, [])


def _withdraw(spark: SparkSession, table: str, run_id: str) -> None:
    """Remove what a run that broke off while it was published had moved."""
    files, folder = hadoop_folder(spark, table)
    if not files.exists(folder):
        return
    for status in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{DAY}=*/{RUN}={run_id}")) or []:
        remove_folder(spark, status.getPath().toString())
