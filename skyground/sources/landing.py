"""Landed payloads as DataFrames.

A fetch stores each response as one row: the payload text, what was asked for
(airport, country, page offset, location) and the HTTP status. Parsing starts
from these rows, so it runs on the executors from the first step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyground.functions import variant as V
from skyground.functions.time import utc_timestamp


def read_landing(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet") -> DataFrame:
    """Landed rows in any file format Spark reads; give ``schema`` for text formats."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_documents(spark: SparkSession, path: str, run_at: dt.datetime) -> DataFrame:
    """Bare JSON documents, one per line, stamped with the time of the run."""
    return spark.read.text(path).select(
        F.col("value").alias("payload"),
        utc_timestamp(run_at).alias("extraction_timestamp"),
    )


def as_variant(landing: DataFrame) -> DataFrame:
    """Landed rows with their payload parsed once, as the VARIANT ``parsed``; the text stays only where it is no JSON object.

    Written to Parquet, Spark stores the leaves most documents share as typed columns of their own (shredding), and
    parsing such a landing reads the leaves it needs, not the text. All parsers take either form. A
    column of leaves that holds whole numbers and fractions does not tell 5.0 from 5, which text does.
    """
    parsed = V.with_computed(landing, "parsed", V.document("payload"))
    return parsed.withColumn("payload", F.when(~V.is_object(F.col("parsed")), F.col("payload")))


def explode_states(landing: DataFrame, *, keep_unreadable: bool = False) -> DataFrame:
    """One row per state of each snapshot, its slots as an array of VARIANT.

    Null, empty or absent ``states`` and text that is not JSON give no rows. A
    state that is no array has NULL ``slots``. With ``keep_unreadable`` a payload that is no
    JSON object gives one row with NULL ``slots``, ``_unreadable`` set and its text in ``_document``.
    """
    if not keep_unreadable:
        states = F.try_variant_get(V.landed_document(landing), "$.states", "array<array<variant>>")
        return landing.select("*", F.explode(states).alias("slots")).drop("payload", "parsed")
    docs = V.with_computed(landing, "_doc", V.landed_document(landing))
    docs = docs.withColumn("_unreadable", ~V.is_object(F.col("_doc")))
    nothing = F.array(F.lit(None).cast("array<variant>"))
    states = F.when(F.col("_unreadable"), nothing).otherwise(
        F.try_variant_get(F.col("_doc"), "$.states", "array<array<variant>>")
    )
    return docs.select(
        *[name for name in landing.columns if name not in ("payload", "parsed")],
        "_unreadable",
        F.when(F.col("_unreadable"), F.col("payload")).alias("_document"),
        F.explode(states).alias("slots"),
    )


def unreadable_documents(landing: DataFrame) -> DataFrame:
    """Landed rows whose payload is no JSON object, e.g. an error page; they hold no states."""
    return landing.filter(~V.is_object(V.landed_document(landing)))
