"""Places: parsing, whole-document rejection, categories and the general list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyground.functions import variant as V
from skyground.schemas import GEOGRAPHY_PLACES, conform

# Fixed value: the type of places that count.
CITY = "CITY"


def country_places(landing: DataFrame, targets: DataFrame) -> DataFrame:
    """Landed documents of the target countries.

    No broadcast is asked for: Spark makes one where the targets are measured to be small.
    """
    return landing.join(targets.select("country_code"), "country_code")


def place_items(landing: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per item of the landed documents: their columns, ``document``, ``pos`` and ``item``.

    A country may have many documents; ``document`` orders them (by their text where the landing has no such column) and ``pos``
    the items of one. With ``limit`` a country keeps the first items of that order, whatever their type: each task first cuts
    its documents, then its countries (window group limit), so a country that holds most documents sends ``limit``
    items per task.
    """
    docs = landing.withColumn("items", V.items(V.document("payload"), "$.data"))
    if "document" not in docs.columns:
        docs = docs.withColumn("document", F.col("payload"))
    if limit is not None:
        docs = docs.withColumn("items", F.slice("items", 1, limit))
    rows = docs.drop("payload").select("*", F.posexplode("items").alias("pos", "item")).drop("items")
    if limit is None:
        return rows
    order = Window.partitionBy("country_code").orderBy("document", "pos")
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= limit).drop("_place")


def _or_zero(item: Column, path: str) -> Column:
    """The number at ``path``, 0 when the key is missing."""
    return F.when(V.node(item, path).isNull(), 0.0).otherwise(V.number(item, path))


def _zero_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0)).cast("float")


def _is_city(item: Column) -> Column:
    return F.coalesce((V.kind(item, "$.type") == "STRING") & (V.text(item, "$.type") == CITY), F.lit(False))


def _spoils(item: Column) -> Column:
    """An item that is no object, or a city whose measures cannot be compared or converted.

    A longitude is only converted, and not even that when it is falsy.
    """
    no_longitude = F.coalesce(V.text(item, "$.longitude").isin("", "[]", "{}"), F.lit(False))
    bad_city = V.bad_measures(V.node(item, "$.population"), V.node(item, "$.latitude")) | (
        ~no_longitude & V.bad_numbers(V.node(item, "$.longitude"))
    )
    return ~V.is_object(item) | (_is_city(item) & bad_city)


def _parsed(rows: DataFrame, extraction_timestamp: Column, reason: Column, *marks: Column) -> DataFrame:
    item = F.col("item")
    population = V.node(item, "$.population")
    return rows.select(
        V.integer(item, "$.id").alias("place_id"),
        V.text(item, "$.name").alias("place_name"),
        V.text(item, "$.type").alias("place_type"),
        "country_code",
        F.lit(None).cast("string").alias("country_name"),
        V.text(item, "$.region").alias("region"),
        V.text(item, "$.regionCode").alias("region_code"),
        _zero_as_null(_or_zero(item, "$.latitude")).alias("latitude"),
        _zero_as_null(V.number(item, "$.longitude")).alias("longitude"),
        F.when(population.isNull(), 0).otherwise(V.integer(population)).alias("population"),
        F.lit(None).cast("int").alias("elevation_meters"),
        F.lit(None).cast("string").alias("timezone"),
        extraction_timestamp.alias("extraction_timestamp"),
        reason.alias("reject_reason"),
        *marks,
    )


def _own_reason() -> Column:
    """Why a city cannot be held by the table, whatever its document says."""
    item = F.col("item")
    return F.when(V.bad_whole(V.node(item, "$.id"), V.node(item, "$.population")), "bad_cast")


def parse_places(
    landing: DataFrame,
    extraction_timestamp: Column,
    limit: int | None = None,
    scope: str = "document",
) -> DataFrame:
    """Cities of the landed documents, plus ``reject_reason`` (NULL = accepted).

    ``landing`` has the requested ``country_code`` and ``payload``, and ``document`` where a country has many
    (see :func:`place_items`). All items of a country count, or its first ``limit``, then only cities. One bad item drops
    all cities of its country (scope ``country``, reason ``bad_country``), of its document (``bad_document``), or only itself
    (scope ``row``, ``bad_item``). An id or population that is no int drops its row in all of them (``bad_cast``).

    Scope ``country`` needs a ``limit`` here, which bounds what a country brings together; countries of
    any size go through :func:`mark_places` and :func:`veto_countries`. Without a limit nothing here joins or shuffles.
    """
    if scope not in ("country", "document", "row"):
        raise ValueError(f"scope must be 'country', 'document' or 'row', not {scope!r}")
    if scope == "country" and limit is None:
        raise ValueError("scope 'country' without a limit takes mark_places and veto_countries")
    item = F.col("item")
    if scope == "document" and limit is None:
        spoilt = F.exists(V.items(V.document("payload"), "$.data"), _spoils)
        rows = place_items(V.with_computed(landing, "_spoilt", spoilt))
    else:
        rows = place_items(landing, limit)
        spoilt = _spoils(item)
        if scope != "row":
            # At most ``limit`` rows of a country are left.
            group = ["country_code"] if scope == "country" else ["country_code", "document"]
            spoilt = F.max(spoilt).over(Window.partitionBy(*group))
        rows = rows.withColumn("_spoilt", spoilt)
    bad = f"bad_{'item' if scope == 'row' else scope}"
    reason = F.coalesce(F.when(F.col("_spoilt"), bad), _own_reason())
    return _parsed(rows.filter(_is_city(item)), extraction_timestamp, reason)


def mark_places(landing: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """All cities with what is wrong with their own values, and marks for :func:`veto_countries`.

    ``_spoils`` marks items that spoil their country, ``_city`` those that are cities: an item that is no object spoils
    its country and is none. Other items are left out. Each document is parsed once, without a shuffle.
    """
    item = F.col("item")
    rows = V.with_computed(place_items(landing), "_marks", F.struct(_spoils(item).alias("spoils"), _is_city(item).alias("city")))
    rows = rows.filter("_marks.spoils OR _marks.city")
    return _parsed(
        rows, extraction_timestamp, _own_reason(), F.col("_marks.spoils").alias("_spoils"), F.col("_marks.city").alias("_city")
    )


def veto_countries(marked: DataFrame) -> DataFrame:
    """The cities of :func:`mark_places` with the final ``reject_reason``: ``bad_country`` for all of a country with an item that spoils it.

    ``marked`` is read twice, so it should be a written table: landed documents are then parsed once. What is joined
    is one row per bad country; Spark broadcasts it where it is measured to be small, and splits a hot country where not.
    """
    bad = marked.filter("_spoils").select("country_code").distinct().withColumn("_vetoed", F.lit(True))
    reason = F.when(F.coalesce("_vetoed", F.lit(False)), "bad_country").otherwise(F.col("reject_reason"))
    judged = marked.filter("_city").drop("_spoils", "_city").join(bad, "country_code", "left")
    columns = [c for c in marked.columns if c not in ("_spoils", "_city")]
    return judged.withColumn("reject_reason", reason).select(*columns)


def accepted_places(parsed: DataFrame) -> DataFrame:
    """Cities that passed every rule."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_places(parsed: DataFrame) -> DataFrame:
    """One row per dropped city and its reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "country_code", "place_id", "place_name", "reject_reason", "extraction_timestamp"
    )


# --- fixed values: the ranges of population behind both categories ----------
def population_category(population: Column) -> Column:
    return (
        F.when(population.isNull(), "Unknown")
        .when(population < 100_000, "Small")
        .when(population < 500_000, "Medium")
        .when(population < 2_000_000, "Large")
        .otherwise("Metropolitan")
    )


def elevation_category(population: Column) -> Column:
    return (
        F.when(population.isNull(), "Unknown")
        .when(population < 1_000, "Small")
        .when(population < 100_000, "Medium")
        .when(population < 1_000_000, "Large")
        .otherwise("Very High")
    )


# ------------------------------------------------------------------------------


def enrich_places(places: DataFrame) -> DataFrame:
    """Categories and the extraction day, as the ``geography_places`` relation.

    ``elevation_category`` is derived from the population, like the thresholds
    it has to reproduce.
    """
    population, latitude = F.col("population"), F.col("latitude")
    return conform(
        places.select(
            *places.columns,
            population_category(population).alias("population_category"),
            elevation_category(population).alias("elevation_category"),
            F.when(latitude > 0, "Northern").when(latitude < 0, "Southern").otherwise("Equatorial").alias("hemisphere"),
            F.to_date("extraction_timestamp").alias("extraction_date"),
        ),
        GEOGRAPHY_PLACES,
    )


def largest_request(
    places: DataFrame,
    *,
    place_type: str = CITY,
    min_population: int = 10000,
    descending: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """What the general list asks the service for: one type, a minimum population, sorted by it.

    With a limit Spark keeps that many rows per task instead of sorting the table.
    """
    population = F.col("population")
    ordered = places.filter((F.col("place_type") == place_type) & (population >= min_population)).orderBy(
        population.desc() if descending else population.asc(), F.col("place_id").asc()
    )
    return ordered if limit is None else ordered.limit(limit)


def parse_place_list(items: DataFrame, extraction_timestamp: Column, *key: str) -> DataFrame:
    """Listing items as places with the country of the payload, plus ``reject_reason`` (NULL = accepted); no categories.

    ``key`` names columns of the items to carry. An item that is no object is a ``bad_item``; one with a coordinate that is no number, or an id or population that is no
    int, a ``bad_cast``. Explicit nulls and missing keys are null.
    """
    item = F.col("item")
    bad_cast = V.bad_numbers(*[V.node(item, f"$.{name}") for name in ("latitude", "longitude")]) | V.bad_whole(
        V.node(item, "$.id"), V.node(item, "$.population")
    )
    return items.select(
        *key,
        V.integer(item, "$.id").alias("place_id"),
        V.text(item, "$.name").alias("place_name"),
        V.text(item, "$.type").alias("place_type"),
        V.text(item, "$.countryCode").alias("country_code"),
        V.text(item, "$.country").alias("country_name"),
        V.text(item, "$.region").alias("region"),
        V.text(item, "$.regionCode").alias("region_code"),
        V.number(item, "$.latitude").alias("latitude"),
        V.number(item, "$.longitude").alias("longitude"),
        V.integer(item, "$.population").alias("population"),
        extraction_timestamp.alias("extraction_timestamp"),
        F.when(~V.is_object(item), "bad_item").when(bad_cast, "bad_cast").alias("reject_reason"),
    )


def accepted_place_list(parsed: DataFrame) -> DataFrame:
    """Listed places that passed every rule."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_place_list(parsed: DataFrame, *key: str) -> DataFrame:
    """One row per dropped item: the ``key`` columns carried along, the place and the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*key, "place_id", "place_name", "reject_reason")


def parse_nearby(landing: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """Cities of landed nearby documents, plus ``reject_reason`` (NULL = accepted); the columns of the request
    pass through.

    Ids are kept as text, whatever they are. An item that is no object is a ``bad_item``, one with a measure that is
    no number or a population that is no whole number a ``bad_cast``.
    """
    rows = landing.select("*", F.explode(V.items(V.document("payload"), "$.data")).alias("item")).drop("payload")
    item = F.col("item")
    population = F.try_variant_get(item, "$.population", "bigint")
    people = V.node(item, "$.population")
    bad_cast = V.bad_numbers(*[V.node(item, f"$.{name}") for name in ("latitude", "longitude", "distance")]) | (
        people.isNotNull() & ~F.is_variant_null(people) & population.isNull()
    )
    return rows.select(
        *[name for name in rows.columns if name != "item"],
        V.text(item, "$.id").alias("city_id"),
        V.text(item, "$.name").alias("city_name"),
        V.text(item, "$.countryCode").alias("country_code"),
        V.number(item, "$.latitude").alias("latitude"),
        V.number(item, "$.longitude").alias("longitude"),
        population.alias("population"),
        V.number(item, "$.distance").alias("distance_km"),
        extraction_timestamp.alias("extraction_timestamp"),
        F.when(~V.is_object(item), "bad_item").when(bad_cast, "bad_cast").alias("reject_reason"),
    )


def accepted_nearby(parsed: DataFrame) -> DataFrame:
    """Nearby cities that passed every rule."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_nearby(parsed: DataFrame, *key: str) -> DataFrame:
    """One row per dropped item: the ``key`` columns of the request, the city and the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*key, "city_id", "city_name", "reject_reason")
