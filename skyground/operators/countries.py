"""Countries: parsing the listing and choosing the ones to fetch places for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyground.functions import variant as V
from skyground.schemas import GEOGRAPHY_COUNTRIES, conform

# Fixed value: the least number of countries to take places from.
MIN_TARGETS = 10


def parse_countries(items: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """``geography_countries`` from listing items that are objects; the first currency stands for all."""
    item = F.col("item")
    return conform(
        items.filter(V.is_object(item)).select(
            V.text(item, "$.code").alias("country_code"),
            V.text(item, "$.name").alias("country_name"),
            V.text(item, "$.currencyCodes[0]").alias("currency_code"),
            V.text(item, "$.continent").alias("continent"),
            extraction_timestamp.alias("extraction_timestamp"),
            F.to_date(extraction_timestamp).alias("extraction_date"),
        ),
        GEOGRAPHY_COUNTRIES,
    )


def rejected_countries(items: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """Listing items that are no objects, as JSON text with their place."""
    item = F.col("item")
    return items.filter(~V.is_object(item)).select(
        (F.col("page_offset") + F.col("pos")).alias("api_pos"),
        V.text(item).alias("raw"),
        F.lit("bad_item").alias("reject_reason"),
        extraction_timestamp.alias("extraction_timestamp"),
    )


def listed_codes(items: DataFrame) -> DataFrame:
    """Country codes of a listing with their place in it."""
    return items.select(
        V.text(F.col("item"), "$.code").alias("country_code"), (F.col("page_offset") + F.col("pos")).alias("api_pos")
    )


def target_countries(api: DataFrame, known: DataFrame, minimum: int = MIN_TARGETS) -> DataFrame:
    """Known codes of the listing in its order, then further known codes up to ``minimum``.

    A code that is listed more than once counts where it comes first. What is numbered are codes of
    the allow-list ``known``, so its window sees a few dozen rows however long the listings are.
    """
    matched = (
        api.join(F.broadcast(known), "country_code")
        .groupBy("country_code")
        .agg(F.lit(True).alias("is_match"), F.min("api_pos").cast("int").alias("pos"))
    )
    fill = known.join(api, "country_code", "left_anti").select(
        "country_code", F.lit(False).alias("is_match"), F.col("known_pos").alias("pos")
    )
    order = Window.orderBy(F.col("is_match").desc(), "pos")
    return (
        matched.unionByName(fill)
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("is_match") | (F.col("position") <= minimum))
        .select("position", "country_code", "is_match")
    )
