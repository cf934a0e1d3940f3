"""Landed weather documents to ``current_weather``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyground.operators import weather as O
from skyground.operators.fetches import fetch_outcomes
from skyground.sources.tables import append_by_day, replace_day, staged


def parsed_weather(airports: DataFrame, landing: DataFrame, *, few_airports: bool = False) -> DataFrame:
    """Parsed documents of the selected airports with their outcome."""
    return O.parse_weather(O.fetched_for(airports, landing, few_airports=few_airports))


def weather_table(
    airports: DataFrame, landing: DataFrame, extraction_timestamp: Column, *, few_airports: bool = False
) -> DataFrame:
    """The ``current_weather`` relation."""
    return O.airport_weather(parsed_weather(airports, landing, few_airports=few_airports), extraction_timestamp)


def weather_outcomes(airports: DataFrame, landing: DataFrame, *, few_airports: bool = False) -> DataFrame:
    """How the fetches of the selected airports ended."""
    return fetch_outcomes(parsed_weather(airports, landing, few_airports=few_airports))


def run_weather(
    airports: DataFrame,
    landing: DataFrame,
    extraction_timestamp: Column,
    table: str,
    *,
    failures: str | None = None,
    replace: bool = False,
    few_airports: bool = False,
    fmt: str = "parquet",
) -> int:
    """Append to the day table, or replace its days on request; returns the number of rows.

    ``few_airports`` asks for a broadcast of the airports, for callers who bound their number. Fetches of the
    airports that did not end well go to the day table ``failures``, each with its outcome; documents are parsed once for both.
    """
    write = replace_day if replace else append_by_day
    parsed = parsed_weather(airports, landing, few_airports=few_airports)
    if failures is None:
        return write(O.airport_weather(parsed, extraction_timestamp), table, fmt=fmt)
    with staged(parsed, "weather") as rows:
        failed = O.failed_weather(rows, "airport_iata_code").withColumn("extraction_timestamp", extraction_timestamp)
        write(failed.withColumn("extraction_date", F.to_date("extraction_timestamp")), failures, fmt=fmt)
        return write(O.airport_weather(rows, extraction_timestamp), table, fmt=fmt)
