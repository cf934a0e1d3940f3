"""Quality gates: aggregates of one day against thresholds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: a metric below its minimum fails the gate -----------------
MINIMUM = {
    "flights": {"record_count": 10},
    "weather": {"record_count": 50, "unique_airports": 20},
    "places": {"record_count": 50, "unique_countries": 10},
}
# ----------------------------------------------------------------------------


class QualityGateError(ValueError):
    """A gate failed."""


def for_day(table: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of one day, by the partition column, so other days are not read."""
    return table.filter(F.col("extraction_date") == F.lit(as_of))


def _metrics(dataset: str, totals: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per metric: dataset, metric, value, threshold, passed (NULL when only logged)."""
    minimum = MINIMUM[dataset]

    def measured(metric: str) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric).cast("double").alias("value"),
            F.lit(minimum.get(metric)).cast("double").alias("threshold"),
        )

    return totals.select(F.inline(F.array(*[measured(metric) for metric in metrics]))).select(
        F.lit(dataset).alias("dataset"), "metric", "value", "threshold", (F.col("value") >= F.col("threshold")).alias("passed")
    )


def _rows(count: str) -> Column:
    return F.coalesce(F.sum(count), F.lit(0)).alias("record_count")


def gate_flights(flights: DataFrame, as_of: dt.date) -> DataFrame:
    """Number of flights of the day."""
    totals = for_day(flights, as_of).agg(F.count(F.lit(1)).alias("record_count"))
    return _metrics("flights", totals, ["record_count"])


def gate_weather(weather: DataFrame, as_of: dt.date) -> DataFrame:
    """Observations and airports of the day; the mean temperature is only logged.

    Counting per airport first keeps the distinct count to one light shuffle.
    """
    per_airport = (
        for_day(weather, as_of)
        .groupBy("airport_iata_code")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("temperature").alias("degrees"),
            F.count("temperature").alias("measured"),
        )
    )
    mean = F.try_divide(F.sum("degrees"), F.sum("measured"))
    totals = per_airport.agg(
        _rows("n"),
        F.count("airport_iata_code").alias("unique_airports"),
        F.round(F.coalesce(mean, F.lit(0.0)), 6).alias("avg_temperature"),
    )
    return _metrics("weather", totals, ["record_count", "unique_airports", "avg_temperature"])


def gate_places(places: DataFrame, as_of: dt.date) -> DataFrame:
    """Places and countries of the day; the number of place types is only logged.

    Counting per (country, type) first leaves a handful of rows for the two
    distinct counts, which would otherwise copy every input row.
    """
    per_group = for_day(places, as_of).groupBy("country_code", "place_type").agg(F.count(F.lit(1)).alias("n"))
    totals = per_group.agg(
        _rows("n"),
        F.count_distinct("country_code").alias("unique_countries"),
        F.count_distinct("place_type").alias("unique_place_types"),
    )
    return _metrics("places", totals, ["record_count", "unique_countries", "unique_place_types"])


def gate_all(*gates: DataFrame) -> DataFrame:
    """Whether each dataset passed, and ``all`` of them."""
    rows = gates[0]
    for gate in gates[1:]:
        rows = rows.unionByName(gate)
    return (
        rows.rollup("dataset")
        .agg(F.bool_and("passed").alias("passed"), F.count("threshold").alias("checks"))
        .withColumn("dataset", F.coalesce("dataset", F.lit("all")))
    )


def failures(gate: DataFrame) -> list[str]:
    """What failed, in words. A gate has one row per metric, so collecting it is safe."""
    return [
        f"{r.dataset} {r.metric} is {r.value:g}, at least {r.threshold:g} expected"
        for r in gate.filter(~F.col("passed")).collect()
    ]


def enforce(gate: DataFrame) -> None:
    """Raise when a gate failed."""
    failed = failures(gate)
    if failed:
        raise QualityGateError("; ".join(failed))
