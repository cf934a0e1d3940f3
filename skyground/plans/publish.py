"""One day whose tables are published only where their gates pass."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from skyground.functions.time import utc_timestamp
from skyground.operators import quality as Q
from skyground.plans import flights as PF, geography as PG, weather as PW
from skyground.sources.publish import Outcome, RunLedger, write_audit_publish


class DatasetRun(NamedTuple):
    dataset: str
    outcome: Outcome


def publish_daily(
    spark: SparkSession,
    out: str,
    *,
    run_id: str,
    run_at: dt.datetime,
    states: DataFrame | None = None,
    airports: DataFrame | None = None,
    weather: DataFrame | None = None,
    country_pages: DataFrame | None = None,
    place_documents: DataFrame | None = None,
    per_country: int | None = None,
) -> list[DatasetRun]:
    """Stage, audit and publish the tables whose inputs are given, below ``out``; the ledger is ``out/runs``.

    Each dataset stands for itself: one that fails its gate stays staged and the others are published. Countries have
    no gate. The same ``run_id`` again adds nothing to what it published and tries again what it did not.
    """
    stamp, day = utc_timestamp(run_at), run_at.astimezone(dt.timezone.utc).date()
    ledger = RunLedger(spark, f"{out}/runs")
    runs: list[DatasetRun] = []

    def publish(dataset: str, make, gate=None) -> None:
        done = ledger.rows(dataset, run_id)
        if done is None:
            judged = None if gate is None else lambda table: gate(table, day)
            outcome = write_audit_publish(make(), f"{out}/{dataset}", dataset, run_id, ledger, judged)
        else:
            outcome = Outcome(done, True, True, [])
        runs.append(DatasetRun(dataset, outcome))

    if states is not None:
        publish("current_flights", lambda: PF.flights_table(states), Q.gate_flights)
    if airports is not None and weather is not None:
        publish("current_weather", lambda: PW.weather_table(airports, weather, stamp), Q.gate_weather)
    if country_pages is not None:
        items = PG.country_items(country_pages)
        if place_documents is not None:
            places = lambda: PG.places_table(place_documents, PG.targets(items), stamp, per_country)
            publish("geography_places", places, Q.gate_places)
        publish("geography_countries", lambda: PG.countries_table(items, stamp))
    return runs
