"""The latest row per key of an append-only table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row per ``key`` in the given order; rows without a key are all kept.

    Spark cuts each map task to one row per key before the shuffle (window
    group limit), so a key that holds most rows costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    known = df.filter(F.col(key).isNotNull()).withColumn("rank", rank).filter(F.col("rank") == 1).drop("rank")
    return known.unionByName(df.filter(F.col(key).isNull()))


def current_flights(flights: DataFrame, *tie_break: Column) -> DataFrame:
    """The latest state of each aircraft."""
    return latest_by(
        flights,
        "icao24",
        F.col("extraction_timestamp").desc(),
        F.col("last_contact").desc_nulls_last(),
        *tie_break,
    )


def current_weather(weather: DataFrame, *tie_break: Column) -> DataFrame:
    """The latest observation of each airport."""
    return latest_by(weather, "airport_iata_code", F.col("extraction_timestamp").desc(), *tie_break)
