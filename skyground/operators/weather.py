"""Airport weather: parsing landed documents and joining them to airports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyground.functions import variant as V
from skyground.operators.fetches import classify_fetch
from skyground.schemas import CURRENT_WEATHER, conform

# --- fixed values: paths in a weather document ------------------------------
SECTIONS = ["$.main", "$.wind", "$.clouds", "$.sys"]
NUMBERS = [
    ("temperature", "$.main.temp"),
    ("feels_like", "$.main.feels_like"),
    ("wind_speed", "$.wind.speed"),
    ("wind_gust", "$.wind.gust"),
]
WHOLE_NUMBERS = [
    ("timezone_offset", "$.timezone"),
    ("humidity", "$.main.humidity"),
    ("pressure", "$.main.pressure"),
    ("cloudiness", "$.clouds.all"),
    ("visibility", "$.visibility"),
    ("wind_direction", "$.wind.deg"),
]
EPOCHS = [("sunrise", "$.sys.sunrise"), ("sunset", "$.sys.sunset")]
CONDITIONS = [
    ("weather_main", "$.weather[0].main"),
    ("weather_description", "$.weather[0].description"),
    ("weather_icon", "$.weather[0].icon"),
]
# Columns no document fills.
PLACEHOLDERS = [("timezone", "string"), ("dew_point", "double"), ("uvi", "double")]
# ----------------------------------------------------------------------------


def _nodes(doc: Column, leaves: list[tuple[str, str]]) -> list[Column]:
    return [V.node(doc, path) for _, path in leaves]


def _bad_conditions(doc: Column) -> Column:
    """``weather`` may be absent or falsy, or an array that starts with an object."""
    listed = V.text(doc, "$.weather")
    absent = listed.isNull() | listed.isin("", "[]", "{}", "0", "false")
    return ~absent & ~V.is_object(doc, "$.weather[0]")


def parse_weather(landing: DataFrame) -> DataFrame:
    """Weather columns for every landed document, plus ``outcome``.

    ``landing`` has ``payload`` and ``http_status``; other columns pass through.
    ``bad_payload`` covers text that is not a JSON object, a section that is
    there but no object, and a leaf of the wrong kind.
    """
    stored = "parsed" in landing.columns
    if stored:
        # Leaves are asked of the stored column itself, so that the scan reads them alone.
        docs = landing.drop("payload").withColumnRenamed("parsed", "doc")
    else:
        docs = V.with_computed(landing, "doc", V.document("payload")).drop("payload")
    doc = F.col("doc")
    bad = (
        ~V.is_object(doc)
        | V.bad_sections(*[V.node(doc, path) for path in SECTIONS])
        | _bad_conditions(doc)
        | V.bad_numbers(*_nodes(doc, NUMBERS))
        | V.bad_whole(*_nodes(doc, WHOLE_NUMBERS), stored=stored)
        | V.bad_epochs(*_nodes(doc, EPOCHS))
    )
    typed = docs.select(
        *[name for name in docs.columns if name != "doc"],
        *[V.number(doc, path).alias(name) for name, path in NUMBERS],
        *[V.integer(doc, path).alias(name) for name, path in WHOLE_NUMBERS],
        *[V.epoch(doc, path).alias(name) for name, path in EPOCHS],
        *[V.text(doc, path).alias(name) for name, path in CONDITIONS],
        *[F.lit(None).cast(data_type).alias(name) for name, data_type in PLACEHOLDERS],
        bad.alias("bad"),
    )
    return V.with_computed(typed, "outcome", classify_fetch(F.col("http_status"), F.col("bad"))).drop("http_status", "bad")


def good_weather(parsed: DataFrame) -> DataFrame:
    """Documents that were fetched and parsed."""
    return parsed.filter(F.col("outcome") == "ok").drop("outcome")


def failed_weather(parsed: DataFrame, *key: str) -> DataFrame:
    """The other documents: the ``key`` columns and how they failed."""
    return parsed.filter(F.col("outcome") != "ok").select(*key, "outcome")


def fetched_for(airports: DataFrame, landing: DataFrame, *, few_airports: bool = False) -> DataFrame:
    """Landed weather documents of the given airports, airport columns alongside.

    Joining before parsing means only wanted documents are parsed. Set
    ``few_airports`` when a limit bounds the airports: they are then broadcast
    and the documents are not shuffled. Otherwise Spark picks the join.
    """
    info = airports.select(
        F.col("iata_code"),
        F.col("iata_code").alias("airport_iata_code"),
        F.col("icao_code").alias("airport_icao_code"),
        F.col("name").alias("airport_name"),
        F.col("municipality").alias("airport_municipality"),
        F.col("country").alias("airport_country"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "elevation_ft",
    )
    return landing.join(F.broadcast(info) if few_airports else info, "iata_code").drop("iata_code")


def airport_weather(parsed: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """The ``current_weather`` relation from parsed documents with airport columns."""
    stamped = good_weather(parsed).withColumn("extraction_timestamp", extraction_timestamp)
    return conform(stamped.withColumn("extraction_date", F.to_date("extraction_timestamp")), CURRENT_WEATHER)
