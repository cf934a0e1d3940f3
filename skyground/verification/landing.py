"""Landed payloads made from the adapters, so that queries start from raw JSON.

Spark builds every payload. Documents that hold several items hold a bounded
number of them: one page, some hundreds of states, or the places of a country within a range of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyground.operators.places import largest_request
from skyground.operators.spatial import nearby_places
from skyground.verification import adapters as A

KEEP_NULLS = {"ignoreNullFields": "false"}
# Places of a country whose ids fall into one range share a document, so that documents stay small.
IDS_PER_DOCUMENT = 300
IDS_PER_LISTING = 150


def _quoted(value: str) -> Column:
    return F.concat(F.lit('"'), F.col(value), F.lit('"'))


def _state() -> Column:
    """One state as JSON; short rows lose their last slot."""
    slots = [
        *[_quoted(name) for name in ("icao24", "callsign", "origin_country")],
        *[F.col(name).cast("string") for name in ("time_position", "last_contact", "longitude", "latitude", "baro_altitude", "on_ground")],
        F.when(F.col("bad_cast"), '"n/a"').otherwise(F.col("velocity").cast("string")),
        *[F.col(name).cast("string") for name in ("true_track", "vertical_rate", "sensors", "geo_altitude")],
        _quoted("squawk"),
        F.col("spi").cast("string"),
        F.col("position_source").cast("string"),
    ]
    kept = F.slice(F.array(*slots), F.lit(1), F.col("n_fields"))
    return F.concat(F.lit("["), F.array_join(kept, ",", "null"), F.lit("]"))


def _snapshot(states: Column) -> Column:
    return F.concat(
        F.lit('{"time":'), F.unix_timestamp("extraction_timestamp").cast("string"), F.lit(',"states":['), states, F.lit("]}")
    )


def states_landing(states: DataFrame) -> DataFrame:
    """One snapshot document per event: no shuffle, however many events a moment has."""
    return states.select(_snapshot(_state()).alias("payload"), "extraction_timestamp", "event_id")


def hourly_snapshots(states: DataFrame) -> DataFrame:
    """The states of an hour together, at most some hundreds a document, and documents that hold none.

    Every hour also has an answer without states: null, an empty list or no such member.
    """
    hour = F.date_trunc("hour", "extraction_timestamp")
    kept = states.select(hour.alias("extraction_timestamp"), F.expr("event_id div 500").alias("part"), _state().alias("state"))
    parts = kept.groupBy("extraction_timestamp", "part").agg(F.array_join(F.collect_list("state"), ",").alias("states"))
    full = parts.select(_snapshot(F.col("states")).alias("payload"), "extraction_timestamp")
    nothing = F.array(*[F.lit(text) for text in ('{"time":0,"states":null}', '{"time":0,"states":[]}', '{"time":0}')])
    empty = kept.select("extraction_timestamp").distinct().select(F.explode(nothing).alias("payload"), "extraction_timestamp")
    return full.unionByName(empty)


def weather_landing(weather: DataFrame) -> DataFrame:
    """One document per airport. Failed fetches carry the error text of the service."""
    main = F.to_json(F.struct("temp", "feels_like", "humidity", "pressure"))
    rest = F.to_json(
        F.struct(
            F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg"), F.col("wind_gust").alias("gust")).alias("wind"),
            F.struct(F.col("clouds_all").alias("all")).alias("clouds"),
            F.struct("sunrise", "sunset").alias("sys"),
            F.col("visibility"),
            F.col("timezone_offset").alias("timezone"),
            F.when(F.col("weather_empty"), F.array().cast("array<struct<main:string,description:string,icon:string>>"))
            .otherwise(
                F.array(
                    F.struct(
                        F.col("weather_main").alias("main"),
                        F.col("weather_description").alias("description"),
                        F.col("weather_icon").alias("icon"),
                    )
                )
            )
            .alias("weather"),
        )
    )
    body = F.concat(
        F.lit('{"main":'), F.when(F.col("main_is_null"), "null").otherwise(main), F.lit(","), F.substring(rest, F.lit(2), F.length(rest))
    )
    failed = F.format_string('{"cod":%d,"message":"failed"}', "http_status")
    return weather.select("iata_code", "http_status", F.when(F.col("http_status") == 200, body).otherwise(failed).alias("payload"))


def _documents(rows: DataFrame, by: list[str], position: str, item: Column) -> DataFrame:
    """One ``{"data":[..]}`` document per group; the caller bounds the groups."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(position).alias("at"), item.alias("json"))))
    texts = F.transform(ordered, lambda entry: entry["json"])
    return rows.groupBy(*by).agg(F.concat(F.lit('{"data":['), F.array_join(texts, ","), F.lit("]}")).alias("payload"))


def country_pages(countries: DataFrame) -> DataFrame:
    """The country listing in pages of at most 10."""
    currencies = F.when(F.col("first_currency").isNull(), F.array().cast("array<string>")).otherwise(
        F.array("first_currency", F.lit("XXX"))
    )
    item = F.to_json(F.struct("code", "name", currencies.alias("currencyCodes"), "continent"))
    # Not a literal: joins on it would have no key left.
    listed = countries.withColumn("listing", F.when(F.col("pos").isNotNull(), "countries"))
    return _documents(listed, ["listing", "page_offset"], "pos", item)


def _place(population: Column) -> Column:
    return F.struct(
        F.col("place_id").alias("id"),
        F.col("place_name").alias("name"),
        F.col("place_type").alias("type"),
        F.col("country_code").alias("countryCode"),
        "region",
        F.col("region_code").alias("regionCode"),
        "latitude",
        "longitude",
        population.alias("population"),
    )


def country_documents(places: DataFrame) -> DataFrame:
    """All places of each country, in as many small documents as that takes."""
    chunked = places.withColumn("chunk", F.expr(f"place_id div {IDS_PER_DOCUMENT}"))
    # Explicit nulls stay; a missing population has no key at all.
    full = F.to_json(_place(F.col("population")), KEEP_NULLS)
    bare = F.to_json(_place(F.col("population")).dropFields("population"), KEEP_NULLS)
    documents = _documents(
        chunked, ["country_code", "chunk"], "place_id", F.when(F.col("population_missing"), bare).otherwise(full)
    )
    return documents.withColumnRenamed("chunk", "document")


def place_pages(places: DataFrame) -> DataFrame:
    """General place lists in pages of 10, as the service would cut them; one list per range of ids."""
    asked = largest_request(places).withColumn("listing", F.expr(f"place_id div {IDS_PER_LISTING}").cast("string"))
    at = F.row_number().over(Window.partitionBy("listing").orderBy("population", "place_id")) - 1
    numbered = asked.withColumn("at", at).withColumn("page_offset", F.floor(F.col("at") / 10).cast("int") * 10)
    item = F.to_json(_place(F.col("population")), KEEP_NULLS)
    landed = _documents(numbered, ["listing", "page_offset"], "at", item)
    # Only an empty page tells that a list of full pages ends.
    sizes = asked.groupBy("listing").agg(F.count(F.lit(1)).alias("n")).filter("n % 10 = 0")
    ends = sizes.select("listing", F.col("n").cast("int").alias("page_offset"), F.lit('{"data":[]}').alias("payload"))
    return landed.unionByName(ends)


def nearby_documents(places: DataFrame, airports: DataFrame) -> DataFrame:
    """One document per airport with its closest places, at most the limit of the request."""
    item = F.to_json(
        F.struct(
            F.col("city_id").alias("id"),
            F.col("city_name").alias("name"),
            F.col("country_code").alias("countryCode"),
            "latitude",
            "longitude",
            "population",
            F.col("distance_km").alias("distance"),
        ),
        KEEP_NULLS,
    )
    near = nearby_places(places, airports)
    return _documents(near, ["airport_iata_code"], "rank", item)


def states(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    return A.adapter(spark, sf_dir, A.STATES, even)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.adapter(spark, sf_dir, A.AIRPORTS)


def weather(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    return A.adapter(spark, sf_dir, A.WEATHER, even)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.adapter(spark, sf_dir, A.COUNTRIES)


def places(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    return A.adapter(spark, sf_dir, A.PLACES, even)
