"""One day: flights, weather, geography, then the gates over what was written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from skyground.functions.time import utc_timestamp
from skyground.operators import quality as Q
from skyground.plans.flights import run_flights
from skyground.plans.geography import run_geography
from skyground.plans.weather import run_weather
from skyground.schemas import CURRENT_FLIGHTS, CURRENT_WEATHER, GEOGRAPHY_PLACES
from skyground.sources.tables import read_table


def run_daily(
    spark: SparkSession,
    out: str,
    *,
    states: DataFrame,
    airports: DataFrame,
    weather: DataFrame,
    country_pages: DataFrame,
    place_documents: DataFrame,
    run_at: dt.datetime,
    compact_flights: bool = False,
    few_airports: bool = False,
    per_country: int | None = None,
    replace: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Write the four tables below ``out``, what was left out of them below ``out/rejects``, and return the gate
    rows of the day.

    ``per_country`` takes that many items of each country. A run appends; with ``replace`` it writes the days it holds anew. A day without rows gives
    gates that fail, whether or not the tables held anything before. Call :func:`skyground.operators.quality.enforce`
    on the result to stop on a failed gate.
    """
    stamp = utc_timestamp(run_at)
    how = {"replace": replace, "fmt": fmt}
    run_flights(states, f"{out}/current_flights", rejects=f"{out}/rejects/flights", compact=compact_flights, **how)
    run_weather(
        airports,
        weather,
        stamp,
        f"{out}/current_weather",
        failures=f"{out}/rejects/weather",
        few_airports=few_airports,
        **how,
    )
    run_geography(
        country_pages,
        place_documents,
        stamp,
        f"{out}/geography_places",
        f"{out}/geography_countries",
        rejects=f"{out}/rejects",
        per_country=per_country,
        **how,
    )
    day = run_at.astimezone(dt.timezone.utc).date()
    return (
        Q.gate_flights(read_table(spark, f"{out}/current_flights", CURRENT_FLIGHTS, fmt), day)
        .unionByName(Q.gate_weather(read_table(spark, f"{out}/current_weather", CURRENT_WEATHER, fmt), day))
        .unionByName(Q.gate_places(read_table(spark, f"{out}/geography_places", GEOGRAPHY_PLACES, fmt), day))
    )
