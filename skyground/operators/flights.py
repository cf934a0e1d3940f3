"""Flight states: parsing, rejection and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyground.functions import text as X, variant as V
from skyground.sources.landing import explode_states

# --- fixed values: slots of a state array -----------------------------------
STATE_SLOTS = [
    (0, "icao24", "text"),
    (1, "callsign", "text"),
    (2, "origin_country", "text"),
    (3, "time_position", "integer"),
    (4, "last_contact", "integer"),
    (5, "longitude", "number"),
    (6, "latitude", "number"),
    (7, "baro_altitude", "number"),
    (8, "on_ground", "truth"),
    (9, "velocity", "number"),
    (10, "true_track", "number"),
    (11, "vertical_rate", "number"),
    (12, "sensors", "text"),
    (13, "geo_altitude", "number"),
    (14, "squawk", "text"),
    (15, "spi", "truth"),
    (16, "position_source", "integer"),
]

FEET_PER_METRE = 3.28084
KNOTS_PER_METRE_PER_SECOND = 1.94384
FEET_PER_MINUTE_PER_METRE_PER_SECOND = 196.85
# ----------------------------------------------------------------------------


_READ = {
    "text": lambda slot: X.strip(V.text(slot)),
    "integer": V.integer,
    "number": V.number,
    "truth": V.truth,
}


def _slots(*forms: str) -> list[Column]:
    return [F.get("slots", F.lit(position)) for position, _, form in STATE_SLOTS if form in forms]


def parse_states(landing: DataFrame, *, keep_unreadable: bool = False) -> DataFrame:
    """Typed columns for every landed state, plus ``reject_reason`` (NULL = accepted).

    ``landing`` has ``payload`` and ``extraction_timestamp``; other columns pass
    through. Reasons, first match wins: ``arity`` (fewer than 17 slots or no
    array), ``bad_cast`` (a number slot holds something else), ``no_position``.
    With ``keep_unreadable`` each payload that is no JSON object is a row with the reason ``unreadable``.
    """
    states = explode_states(landing, keep_unreadable=keep_unreadable)
    typed = states.select(
        *[_READ[form](F.get("slots", F.lit(position))).alias(name) for position, name, form in STATE_SLOTS],
        *states.columns,
        (V.bad_numbers(*_slots("number")) | V.bad_integers(*_slots("integer"))).alias("bad_cast"),
    )
    unreadable = F.col("_unreadable") if keep_unreadable else F.lit(False)
    reason = (
        F.when(unreadable, "unreadable")
        .when(F.coalesce(F.size("slots"), F.lit(0)) < len(STATE_SLOTS), "arity")
        .when(F.col("bad_cast"), "bad_cast")
        .when(F.col("longitude").isNull() | F.col("latitude").isNull(), "no_position")
    )
    return V.with_computed(typed, "reject_reason", reason).drop("bad_cast")


def accepted_states(parsed: DataFrame) -> DataFrame:
    """States that passed every rule."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "slots", "raw", "_unreadable", "_document")


def with_raw(parsed: DataFrame) -> DataFrame:
    """``parsed`` with the text of the rejected states as ``raw`` in place of all slots."""
    text = F.to_json("slots")
    if "_document" in parsed.columns:
        text = F.coalesce(text, F.col("_document"))
    raw = F.when(F.col("reject_reason").isNotNull(), text)
    return parsed.withColumn("raw", raw).drop("slots", "_unreadable", "_document")


def rejected_states(parsed: DataFrame) -> DataFrame:
    """One row per dropped state: its reason and its raw text, other landing columns kept."""
    names = [name for _, name, _ in STATE_SLOTS]
    judged = parsed if "raw" in parsed.columns else with_raw(parsed)
    return judged.filter(F.col("reject_reason").isNotNull()).drop(*names)


def airborne_flights(flights: DataFrame) -> DataFrame:
    """Flights known to be in the air; an unknown ``on_ground`` is left out."""
    return flights.filter(~F.col("on_ground"))


def enrich_flights(flights: DataFrame) -> DataFrame:
    """Imperial units, status labels and the extraction day, in one projection."""
    on_ground = F.col("on_ground")
    return flights.select(
        "*",
        (F.col("baro_altitude") * FEET_PER_METRE).alias("altitude_ft"),
        (F.col("velocity") * KNOTS_PER_METRE_PER_SECOND).alias("velocity_knots"),
        (F.col("vertical_rate") * FEET_PER_MINUTE_PER_METRE_PER_SECOND).alias("vertical_rate_fpm"),
        F.when(on_ground, "On Ground").when(~on_ground, "Airborne").otherwise("Unknown").alias("flight_status"),
        (F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).alias("has_position"),
        F.col("baro_altitude").isNotNull().alias("has_altitude"),
        F.to_date("extraction_timestamp").alias("extraction_date"),
    )
