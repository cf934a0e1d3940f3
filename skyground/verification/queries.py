"""The registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyground.functions.text import location_key
from skyground.functions.time import utc_timestamp
from skyground.operators import airports as AP, current as CU, distinct as DI, flights as FL, places as PL
from skyground.operators import quality as Q, spatial as SP, weather as WE
from skyground.operators.fetches import fetch_outcomes
from skyground.plans import daily, flights as PF, geography as PG, weather as PW
from skyground.plans.publish import publish_daily
from skyground.schemas import CURRENT_WEATHER, GEOGRAPHY_COUNTRIES, GEOGRAPHY_PLACES, known_countries
from skyground.session import pin_session, session_folder
from skyground.sources.airports import airports_or_static
from skyground.sources.landing import as_variant
from skyground.sources.pages import assemble_pages, missing_pages, void_listings
from skyground.sources.publish import RunLedger, read_runs, read_staged, write_audit_publish
from skyground.sources.tables import append_by_day, replace_day, written
from skyground.sources.view import CurrentView
from skyground.streaming.ingest import flights_stream, ingest, ingest_landing, landing_stream
from skyground.verification import landing as L

RUN_AT = dt.datetime(2024, 1, 15, 12, tzinfo=dt.timezone.utc)
EARLIER = RUN_AT - dt.timedelta(days=1)
AS_OF = RUN_AT.date()

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds and floats as doubles, which every engine prints alike."""

    def plain(field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            name = field.name.removesuffix("_timestamp")
            return F.unix_timestamp(field.name).alias(f"{name}_epoch")
        if isinstance(field.dataType, T.FloatType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


# --- relations several queries build on --------------------------------------
# Where tables are written anyway, ``even`` deals the rows over the cores before payloads are built and parsed.
def _states_landing(spark: SparkSession, sf: str, even: bool = False) -> DataFrame:
    return L.states_landing(L.states(spark, sf, even))


def _flights(spark: SparkSession, sf: str) -> DataFrame:
    return FL.enrich_flights(L.states(spark, sf))


def _placed_states(spark: SparkSession, sf: str) -> DataFrame:
    """What a radius search needs of the states, which travel whole."""
    return L.states(spark, sf).select("event_id", "icao24", "latitude", "longitude", "on_ground")


def _airports(spark: SparkSession, sf: str, limit: int | None = None) -> DataFrame:
    return AP.select_airports(L.airports(spark, sf), limit)


def _weather_landing(spark: SparkSession, sf: str, even: bool = False) -> DataFrame:
    return L.weather_landing(L.weather(spark, sf, even))


def _weather(spark: SparkSession, sf: str, run_at: dt.datetime = RUN_AT, even: bool = False) -> DataFrame:
    return PW.weather_table(_airports(spark, sf), _weather_landing(spark, sf, even), utc_timestamp(run_at))


def _country_pages(spark: SparkSession, sf: str) -> DataFrame:
    return L.country_pages(L.countries(spark, sf))


def _country_items(spark: SparkSession, sf: str) -> DataFrame:
    return PG.country_items(_country_pages(spark, sf))


def _documents(spark: SparkSession, sf: str, even: bool = False) -> DataFrame:
    return L.country_documents(L.places(spark, sf, even))


def _judged_places(spark: SparkSession, sf: str, limit: int | None = None) -> DataFrame:
    return PG.judged_places(_documents(spark, sf), known_countries(spark), utc_timestamp(RUN_AT), limit)


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return PG.places_table(_documents(spark, sf), known_countries(spark), utc_timestamp(RUN_AT))


def _cities(spark: SparkSession, sf: str) -> DataFrame:
    return L.places(spark, sf).filter(F.col("place_type") == PL.CITY)


# --- queries ------------------------------------------------------------------
def q01_parse_states(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(FL.accepted_states(FL.parse_states(_states_landing(spark, sf))))


def q02_state_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = FL.rejected_states(FL.parse_states(_states_landing(spark, sf)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("states"))


def q03_airborne(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(FL.airborne_flights(L.states(spark, sf)))


def q04_enrich_flights(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_flights(spark, sf))


def q05_airports(spark: SparkSession, sf: str) -> DataFrame:
    return _airports(spark, sf, 500)


def q06_static_airports(spark: SparkSession, sf: str) -> DataFrame:
    # No such table is given, so the read fails over to the static airports.
    airports = airports_or_static(spark, f"{sf}/airports.parquet")
    near = SP.flights_near_airport(L.states(spark, sf), airports, 500, few_airports=True)
    return near.groupBy("airport_iata_code").agg(
        F.count(F.lit(1)).alias("flights"), F.min("distance_km").alias("nearest_km"), F.max("distance_km").alias("farthest_km")
    )


def q07_parse_weather(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(WE.good_weather(WE.parse_weather(_weather_landing(spark, sf))))


def q08_airport_weather(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_weather(spark, sf))


def q09_fetch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return fetch_outcomes(WE.parse_weather(_weather_landing(spark, sf)))


def q10_countries(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(PG.countries_table(_country_items(spark, sf), utc_timestamp(RUN_AT)))


def q11_target_countries(spark: SparkSession, sf: str) -> DataFrame:
    return PG.targets(_country_items(spark, sf))


def q12_parse_places(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(PL.accepted_places(_judged_places(spark, sf)))


def q13_enrich_places(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(_places(spark, sf))


def q14_place_list(spark: SparkSession, sf: str) -> DataFrame:
    items = assemble_pages(L.place_pages(L.places(spark, sf)), page_size=10)
    return comparable(PL.accepted_place_list(PL.parse_place_list(items, utc_timestamp(RUN_AT))))


def q15_location_key(spark: SparkSession, sf: str) -> DataFrame:
    # Five places, so that every second key is a half, or next to one, before it is rounded.
    fine = L.airports(spark, sf).select(
        "c_custkey",
        F.expr("(c_custkey * 7919L % 18000000) / 100000.0d - 90.0d").alias("lat"),
        F.expr("(c_custkey * 104729L % 36000000) / 100000.0d - 180.0d").alias("lon"),
    )
    return fine.select("c_custkey", location_key(F.col("lat"), F.col("lon")).alias("location_key"))


def q16_gate_flights(spark: SparkSession, sf: str) -> DataFrame:
    return Q.gate_flights(_flights(spark, sf), AS_OF)


def q17_gate_weather(spark: SparkSession, sf: str) -> DataFrame:
    return Q.gate_weather(_weather(spark, sf), AS_OF)


def q18_gate_places(spark: SparkSession, sf: str) -> DataFrame:
    return Q.gate_places(_places(spark, sf), AS_OF)


def q19_gate_all(spark: SparkSession, sf: str) -> DataFrame:
    return Q.gate_all(q16_gate_flights(spark, sf), q17_gate_weather(spark, sf), q18_gate_places(spark, sf))


def q20_flights_near_airport(spark: SparkSession, sf: str) -> DataFrame:
    near = SP.flights_near_airport(_placed_states(spark, sf), _airports(spark, sf), 200)
    return near.select("event_id", "icao24", "airport_iata_code", "distance_km")


def q21_nearby_places(spark: SparkSession, sf: str) -> DataFrame:
    return SP.nearby_places(_cities(spark, sf), _airports(spark, sf), 1000, 50)


def q22_current_flights(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(CU.current_flights(_flights(spark, sf), F.col("event_id").desc()))


def _per_day(table: DataFrame) -> DataFrame:
    return table.groupBy("extraction_date").agg(
        F.count(F.lit(1)).alias("flights"),
        F.count("altitude_ft").alias("with_altitude"),
        F.round(F.sum("velocity_knots"), 3).alias("sum_knots"),
    )


def q23_day_partitions(spark: SparkSession, sf: str) -> DataFrame:
    table = session_folder(spark, "q23")
    append_by_day(_flights(spark, sf), table, compact=True)
    return _per_day(spark.read.parquet(table))


def q24_replace_day(spark: SparkSession, sf: str) -> DataFrame:
    table = session_folder(spark, "q24")
    for _ in range(2):
        replace_day(_flights(spark, sf), table, compact=True)
    return _per_day(spark.read.parquet(table))


def q25_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    # The same snapshots land twice, as when two schedules start the same day's run.
    folder = session_folder(spark, "q25")
    landed = _states_landing(spark, sf, even=True).drop("event_id")
    for _ in range(2):
        landed.write.mode("append").parquet(f"{folder}/landing")
        flights = flights_stream(landing_stream(spark, f"{folder}/landing"))
        ingest(flights, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select(
        "icao24", "last_contact", "origin_country", "latitude", "longitude", "altitude_ft", "squawk", "extraction_date"
    )


def q26_parse_nearby(spark: SparkSession, sf: str) -> DataFrame:
    documents = L.nearby_documents(_cities(spark, sf), _airports(spark, sf))
    return comparable(PL.accepted_nearby(PL.parse_nearby(documents, utc_timestamp(RUN_AT))))


def q27_reject_rows(spark: SparkSession, sf: str) -> DataFrame:
    rejected = FL.rejected_states(FL.parse_states(_states_landing(spark, sf)))
    return rejected.select("event_id", "reject_reason", F.get_json_object("raw", "$[0]").alias("icao24"))


def q28_daily_run(spark: SparkSession, sf: str) -> DataFrame:
    return daily.run_daily(
        spark,
        session_folder(spark, "q28"),
        states=_states_landing(spark, sf, even=True).drop("event_id"),
        airports=_airports(spark, sf),
        weather=_weather_landing(spark, sf, even=True),
        country_pages=_country_pages(spark, sf),
        place_documents=_documents(spark, sf, even=True),
        run_at=RUN_AT,
        compact_flights=True,
    )


def q29_day_tables(spark: SparkSession, sf: str) -> DataFrame:
    # Two runs append to the same day; a replaced day then holds one.
    folder = session_folder(spark, "q29")
    tables = {
        "current_weather": _weather(spark, sf, even=True),
        "geography_places": _places(spark, sf),
        "geography_countries": PG.countries_table(_country_items(spark, sf), utc_timestamp(RUN_AT)),
    }
    # Worked out once, written four times.
    tables = {dataset: written(table, "q29") for dataset, table in tables.items()}
    for name, write in (("appended", append_by_day), ("replaced", replace_day)):
        for _ in range(2):
            for dataset, table in tables.items():
                write(table, f"{folder}/{name}/{dataset}")
    rows = None
    for name in ("appended", "replaced"):
        for dataset, key, text in (
            ("current_weather", "airport_iata_code", "airport_name"),
            ("geography_places", "place_id", "population_category"),
            ("geography_countries", "country_code", "country_name"),
        ):
            part = spark.read.parquet(f"{folder}/{name}/{dataset}").select(
                F.lit(name).alias("how"),
                F.lit(dataset).alias("dataset"),
                F.col(key).cast("string").alias("key"),
                F.col(text).alias("text"),
                "extraction_date",
            )
            rows = part if rows is None else rows.unionByName(part)
    return rows


def q30_current_weather(spark: SparkSession, sf: str) -> DataFrame:
    both = _weather(spark, sf, EARLIER).unionByName(_weather(spark, sf).filter(F.col("cloudiness") < 50))
    return comparable(CU.current_weather(both)).select("airport_iata_code", "cloudiness", "extraction_epoch", "extraction_date")


def q31_flights_near_all_airports(spark: SparkSession, sf: str) -> DataFrame:
    near = SP.flights_near_airport(_placed_states(spark, sf), _airports(spark, sf), 100)
    return near.select("event_id", "icao24", "airport_iata_code", "distance_km")


def q32_airport_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return PW.weather_outcomes(_airports(spark, sf), _weather_landing(spark, sf))


def q33_flights_table(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(PF.flights_table(_states_landing(spark, sf)))


def q34_rejected_places(spark: SparkSession, sf: str) -> DataFrame:
    return comparable(PL.rejected_places(_judged_places(spark, sf)))


def q35_failed_weather(spark: SparkSession, sf: str) -> DataFrame:
    return WE.failed_weather(WE.parse_weather(_weather_landing(spark, sf)), "iata_code")


def _landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Place lists that lack something: pages that failed, were refused, hold no JSON, never landed or landed twice."""
    pages = L.place_pages(L.places(spark, sf)).withColumn("n", F.col("listing").cast("int") % 7)
    last = F.col("page_offset") == 20
    odd = pages.withColumns(
        {
            "http_status": F.when((F.col("n") == 1) & last, 500).when((F.col("n") == 2) & last, 429).otherwise(200),
            "payload": F.when((F.col("n") == 3) & last, "<html>").otherwise(F.col("payload")),
        }
    ).filter(~((F.col("n") == 4) & last))
    again = odd.filter((F.col("n") == 5) & last)
    refused = odd.filter((F.col("n") == 6) & last).withColumn("http_status", F.lit(429))
    return odd.unionByName(again).unionByName(refused).drop("n")


def q36_void_listings(spark: SparkSession, sf: str) -> DataFrame:
    return void_listings(_landed_pages(spark, sf))


def q37_whole_listings(spark: SparkSession, sf: str) -> DataFrame:
    items = PL.parse_place_list(assemble_pages(_landed_pages(spark, sf)), utc_timestamp(RUN_AT))
    return PL.accepted_place_list(items).select("place_id", "place_name", "population")


def q38_empty_day(spark: SparkSession, sf: str) -> DataFrame:
    return daily.run_daily(
        spark,
        session_folder(spark, "q38"),
        states=_states_landing(spark, sf).drop("event_id").filter("false"),
        airports=_airports(spark, sf),
        weather=_weather_landing(spark, sf).filter("false"),
        country_pages=_country_pages(spark, sf),
        place_documents=_documents(spark, sf).filter("false"),
        run_at=RUN_AT,
    )


def q39_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = session_folder(spark, "q39")
    stamp = utc_timestamp(RUN_AT)
    flights = PF.run_flights(_states_landing(spark, sf, even=True).drop("event_id"), f"{folder}/flights", compact=True)
    weather = PW.run_weather(_airports(spark, sf), _weather_landing(spark, sf, even=True), stamp, f"{folder}/weather")
    places, countries = PG.run_geography(
        _country_pages(spark, sf), _documents(spark, sf, even=True), stamp, f"{folder}/places", f"{folder}/countries"
    )
    counts = {"flights": flights.written, "weather": weather, "places": places, "countries": countries}
    return spark.createDataFrame(list(counts.items()), "dataset string, written long")


def q40_rejected_nearby(spark: SparkSession, sf: str) -> DataFrame:
    # Documents of every tenth airport hold latitudes that are no numbers.
    spoilt = F.regexp_replace("payload", '"latitude":[^,]*', '"latitude":"abc"')
    documents = L.nearby_documents(_cities(spark, sf), _airports(spark, sf)).withColumn(
        "payload", F.when(F.col("airport_iata_code").endswith("0"), spoilt).otherwise(F.col("payload"))
    )
    return PL.rejected_nearby(PL.parse_nearby(documents, utc_timestamp(RUN_AT)), "airport_iata_code")


def q41_daily_rejects(spark: SparkSession, sf: str) -> DataFrame:
    out = session_folder(spark, "q41")
    # Every fiftieth snapshot is an error page.
    landed = _states_landing(spark, sf, even=True).withColumn(
        "payload", F.when(F.col("event_id") % 50 == 0, "<html>").otherwise(F.col("payload"))
    )
    daily.run_daily(
        spark,
        out,
        states=landed.drop("event_id"),
        airports=_airports(spark, sf),
        weather=_weather_landing(spark, sf, even=True),
        country_pages=_country_pages(spark, sf),
        place_documents=_documents(spark, sf, even=True),
        run_at=RUN_AT,
    )

    def rows(name: str, schema: str, reason: str, key: Column) -> DataFrame:
        table = spark.read.schema(schema).parquet(f"{out}/rejects/{name}")
        return table.select(F.lit(name).alias("relation"), F.col(reason).alias("reject_reason"), key.alias("key"))

    return (
        rows("flights", "reject_reason string, raw string", "reject_reason", F.get_json_object("raw", "$[0]"))
        .unionByName(rows("weather", "airport_iata_code string, outcome string", "outcome", F.col("airport_iata_code")))
        .unionByName(rows("places", "place_id int, reject_reason string", "reject_reason", F.col("place_id").cast("string")))
    )


def q42_null_sections(spark: SparkSession, sf: str) -> DataFrame:
    # By the last digit of the code, a section is null or the list of conditions holds a null.
    digit = F.right("iata_code", F.lit(1))
    cut = lambda name: F.regexp_replace("payload", rf'"{name}":\{{[^}}]*\}}', f'"{name}":null')
    payload = (
        F.when(digit == "1", cut("wind"))
        .when(digit == "2", cut("clouds"))
        .when(digit == "3", cut("sys"))
        .when(digit == "4", F.regexp_replace("payload", r'"weather":\[[^\]]*\]', '"weather":[null]'))
        .otherwise(F.col("payload"))
    )
    parsed = WE.parse_weather(_weather_landing(spark, sf).withColumn("payload", payload))
    return parsed.select("iata_code", "outcome")


def q43_top_places(spark: SparkSession, sf: str) -> DataFrame:
    # A country's first ten items over all its documents, then cities; a bad one among the ten rejects its country.
    judged = _judged_places(spark, sf, limit=10)
    return comparable(judged.select("country_code", "place_id", "place_name", "population", "reject_reason"))


def q44_missing_pages(spark: SparkSession, sf: str) -> DataFrame:
    # Two further lists are wanted of which nothing landed.
    pages = _landed_pages(spark, sf)
    wanted = L.places(spark, sf).agg(F.max("place_id").alias("n")).select(
        F.explode(F.array(F.expr("concat('more ', n)"), F.expr("concat('more ', n + 1)"))).alias("listing")
    )
    return missing_pages(pages, wanted=wanted)


def q45_rejected_place_list(spark: SparkSession, sf: str) -> DataFrame:
    # By the last digit of the offset in tens, a page holds a bad latitude, a population in text, or an item that is no object.
    kind = F.expr("page_offset div 10 % 4")
    payload = (
        F.when(kind == 1, F.regexp_replace("payload", r'"latitude":[^,]*', '"latitude":"abc"'))
        .when(kind == 2, F.regexp_replace("payload", r'"population":([0-9]+)', r'"population":"$1"'))
        .when(kind == 3, F.regexp_replace("payload", r'"data":\[\{[^}]*\}', '"data":["oops"'))
        .otherwise(F.col("payload"))
    )
    items = assemble_pages(L.place_pages(L.places(spark, sf)).withColumn("payload", payload), page_size=10)
    parsed = PL.parse_place_list(items, utc_timestamp(RUN_AT), "listing", "page_offset")
    return PL.rejected_place_list(parsed, "listing", "page_offset")


def q46_stream_sinks(spark: SparkSession, sf: str) -> DataFrame:
    # Snapshots land twice, every fiftieth an error page; then another stream reads all of them again.
    folder = session_folder(spark, "q46")
    landed = _states_landing(spark, sf, even=True).withColumn(
        "payload", F.when(F.col("event_id") % 50 == 0, "<html>").otherwise(F.col("payload"))
    )
    for checkpoint in ("first", "first", "again"):
        if checkpoint == "first":
            landed.drop("event_id").write.mode("append").parquet(f"{folder}/landing")
        stream = landing_stream(spark, f"{folder}/landing")
        ingest_landing(stream, f"{folder}/flights", f"{folder}/rejects", f"{folder}/{checkpoint}").awaitTermination()
    flights = spark.read.parquet(f"{folder}/flights").select(
        F.lit("flights").alias("sink"), F.lit(None).cast("string").alias("reject_reason"), "icao24", "extraction_date"
    )
    rejects = spark.read.parquet(f"{folder}/rejects").select(
        F.lit("rejects").alias("sink"), "reject_reason", F.get_json_object("raw", "$[0]").alias("icao24"), "extraction_date"
    )
    return flights.unionByName(rejects)


def q47_hourly_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    # Many states a snapshot, and snapshots without any.
    return comparable(FL.accepted_states(FL.parse_states(L.hourly_snapshots(L.states(spark, sf)))))


def q48_incremental_view(spark: SparkSession, sf: str) -> DataFrame:
    # Ten days at a time are appended, and the view refreshed each time.
    folder = session_folder(spark, "q48")
    flights = _flights(spark, sf)
    view = CurrentView(
        spark,
        f"current_flights_{uuid.uuid4().hex}",
        f"{folder}/view",
        f"{folder}/flights",
        flights.schema,
        "icao24",
        ["extraction_timestamp", "last_contact", "event_id"],
        buckets=16,
    )
    third = F.least(F.expr("(day(extraction_date) - 1) div 10"), F.lit(2))
    for n in range(3):
        append_by_day(flights.filter(third == n), f"{folder}/flights", compact=True)
        view.refresh()
    return comparable(view.read())


def q49_nearest_places(spark: SparkSession, sf: str) -> DataFrame:
    return SP.nearest_places(_cities(spark, sf), _airports(spark, sf), 1000, 50)


def q50_run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    # A run that is repeated adds nothing; another run of the day stands beside it.
    folder = session_folder(spark, "q50")
    ledger = RunLedger(spark, f"{folder}/runs")
    weather = written(_weather(spark, sf, even=True), "q50")
    for run_id in ("early", "early", "late"):
        write_audit_publish(weather, f"{folder}/weather", "weather", run_id, ledger)
    table = read_runs(spark, f"{folder}/weather", weather.schema)
    return table.select("airport_iata_code", "temperature", "extraction_date", "run_id")


def q51_audited_run(spark: SparkSession, sf: str) -> DataFrame:
    # Of the wanted countries one is rejected, which leaves too few; the weather of the day passes.
    out = session_folder(spark, "q51")
    runs = {
        run.dataset: run
        for run in publish_daily(
            spark,
            out,
            run_id="daily",
            airports=_airports(spark, sf),
            weather=_weather_landing(spark, sf, even=True),
            country_pages=_country_pages(spark, sf),
            place_documents=_documents(spark, sf, even=True),
            run_at=RUN_AT,
        )
    }

    def rows(name: str, schema: T.StructType, key: str) -> DataFrame:
        if runs[name].outcome.published:
            table = read_runs(spark, f"{out}/{name}", schema)
        else:
            table = read_staged(spark, f"{out}/{name}", "daily", schema)
        where = "published" if runs[name].outcome.published else "staged"
        return table.select(F.lit(name).alias("dataset"), F.lit(where).alias("kept"), F.col(key).cast("string").alias("key"))

    return (
        rows("current_weather", CURRENT_WEATHER, "airport_iata_code")
        .unionByName(rows("geography_places", GEOGRAPHY_PLACES, "place_id"))
        .unionByName(rows("geography_countries", GEOGRAPHY_COUNTRIES, "country_code"))
    )


def q52_distinct_over_days(spark: SparkSession, sf: str) -> DataFrame:
    # Aircraft of rolling weeks, counted from the rows and from sketches stored per day.
    folder = session_folder(spark, "q52")
    flights = _flights(spark, sf)
    append_by_day(DI.day_sketches(flights, "icao24"), folder)
    exact = DI.exact_rolling(flights, "icao24", 7).withColumnRenamed("distinct_values", "aircraft")
    near = DI.approx_rolling(spark.read.parquet(folder), "icao24", 7)
    error = F.abs(F.col("distinct_values") - F.col("aircraft"))
    return exact.join(near, "window_end").select(
        "window_end", "aircraft", (error <= DI.error_bound() * F.col("aircraft")).alias("estimate_within_bound")
    )


def _stored(landing: DataFrame, name: str) -> DataFrame:
    """The landing kept as VARIANT, written and read again."""
    return written(as_variant(landing), name)


def q53_variant_states(spark: SparkSession, sf: str) -> DataFrame:
    landing = _stored(_states_landing(spark, sf, even=True), "q53")
    return comparable(FL.accepted_states(FL.parse_states(landing)))


def q54_variant_weather(spark: SparkSession, sf: str) -> DataFrame:
    landing = _stored(_weather_landing(spark, sf, even=True), "q54")
    return comparable(WE.good_weather(WE.parse_weather(landing)))


def _pinned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(pin_session(spark), sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES: dict[str, Query] = {
    query.__name__: _pinned(query)
    for query in (
        q01_parse_states,
        q02_state_rejects,
        q03_airborne,
        q04_enrich_flights,
        q05_airports,
        q06_static_airports,
        q07_parse_weather,
        q08_airport_weather,
        q09_fetch_outcomes,
        q10_countries,
        q11_target_countries,
        q12_parse_places,
        q13_enrich_places,
        q14_place_list,
        q15_location_key,
        q16_gate_flights,
        q17_gate_weather,
        q18_gate_places,
        q19_gate_all,
        q20_flights_near_airport,
        q21_nearby_places,
        q22_current_flights,
        q23_day_partitions,
        q24_replace_day,
        q25_stream_ingest,
        q26_parse_nearby,
        q27_reject_rows,
        q28_daily_run,
        q29_day_tables,
        q30_current_weather,
        q31_flights_near_all_airports,
        q32_airport_outcomes,
        q33_flights_table,
        q34_rejected_places,
        q35_failed_weather,
        q36_void_listings,
        q37_whole_listings,
        q38_empty_day,
        q39_row_counts,
        q40_rejected_nearby,
        q41_daily_rejects,
        q42_null_sections,
        q43_top_places,
        q44_missing_pages,
        q45_rejected_place_list,
        q46_stream_sinks,
        q47_hourly_snapshots,
        q48_incremental_view,
        q49_nearest_places,
        q50_run_ledger,
        q51_audited_run,
        q52_distinct_over_days,
        q53_variant_states,
        q54_variant_weather,
    )
}
