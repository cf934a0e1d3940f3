"""Helpers the corpus operators share: intermediate tables, identities, read helpers."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyground.session import remove_folder, shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh shared folder that goes when the session's file system closes."""
    path = shared_folder(spark, name)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the running stage and nothing before the table.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    # The shuffle files of the job just done go with its objects, not some time later.
    df.sparkSession.sparkContext._jvm.System.gc()
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def freed(*tables: DataFrame) -> None:
    """Remove :func:`staged` tables whose readers have all been written themselves."""
    for done in tables:
        remove_folder(done.sparkSession, done._staged_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(docs: DataFrame, results: tuple[str, ...], *dropped: str) -> list[str]:
    """Columns of ``docs`` to carry along: all but those named like a result, in any case, or dropped."""
    names = {r.lower() for r in (*results, *dropped)}
    return [c for c in docs.columns if c.lower() not in names]


def boxed(columns: list[str]) -> Column:
    """``columns`` as one, so that no name of theirs meets a working name."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_box")


def unboxed(columns: list[str]) -> list[Column]:
    return [F.col(f"_box.`{c}`").alias(c) for c in columns]


def free_name(columns: list[str], name: str = "_text") -> str:
    """``name``, made longer until no column has it in any case."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, everything else stays; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
