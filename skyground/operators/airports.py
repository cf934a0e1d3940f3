"""Choosing and normalising airports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyground.functions.text import or_default
from skyground.schemas import AIRPORT_INFO, conform


def schedulable_airports(airports: DataFrame) -> DataFrame:
    """Airports with a position, scheduled service and a code."""
    return airports.filter(
        F.col("latitude_deg").isNotNull()
        & F.col("longitude_deg").isNotNull()
        & F.col("scheduled_service")
        & F.col("iata_code").isNotNull()
        & (F.col("iata_code") != "")
    )


def first_by_name(airports: DataFrame, limit: int | None = None) -> DataFrame:
    """The first airports by name, unnamed ones first, code as tie-break; all of them without a limit."""
    ordered = airports.orderBy(F.col("name").asc_nulls_first(), F.col("iata_code").asc())
    return airports if limit is None else ordered.limit(limit)


def normalize_airports(airports: DataFrame) -> DataFrame:
    """Defaults for empty texts and missing positions; elevation cut to whole feet.

    An elevation that is no int (NaN, out of range) drops its row.
    """
    elevation = F.col("elevation_ft").try_cast("int")
    usable = airports.filter(F.col("elevation_ft").isNull() | elevation.isNotNull())
    # The default labels.
    unknown = F.lit("Unknown")
    return conform(
        usable.select(
            "iata_code",
            or_default(F.col("icao_code"), F.col("iata_code")).alias("icao_code"),
            or_default(F.col("name"), F.lit("Unknown Airport")).alias("name"),
            F.coalesce(F.col("latitude_deg").cast("double"), F.lit(0.0)).alias("lat"),
            F.coalesce(F.col("longitude_deg").cast("double"), F.lit(0.0)).alias("lon"),
            elevation.alias("elevation_ft"),
            or_default(F.col("municipality"), unknown).alias("municipality"),
            or_default(F.col("iso_country"), unknown).alias("country"),
        ),
        AIRPORT_INFO,
    )


def drop_null_island(airports: DataFrame) -> DataFrame:
    """Drop airports at latitude 0, longitude 0."""
    return airports.filter(~((F.col("lat") == 0.0) & (F.col("lon") == 0.0)))


def select_airports(airports: DataFrame, limit: int | None = None) -> DataFrame:
    """Schedulable airports, all or the first ``limit`` by name, normalised.

    The limit counts rows before normalisation, so fewer may remain.
    """
    return drop_null_island(normalize_airports(first_by_name(schedulable_airports(airports), limit)))
