"""The registered queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations

from skyground.schemas import KNOWN_COUNTRIES, STATIC_AIRPORTS
from skyground.verification import adapters as A

RUN_EPOCH = "cast(1705320000 as bigint)"
EARLIER_EPOCH = "cast(1705233600 as bigint)"
DAY = "DATE '2024-01-15'"

STATES_SRC = ("states_src", A.duckdb_sql(A.STATES))
AIRPORTS_SRC = ("airports_src", A.duckdb_sql(A.AIRPORTS))
WEATHER_SRC = ("weather_src", A.duckdb_sql(A.WEATHER))
COUNTRIES_SRC = ("countries_src", A.duckdb_sql(A.COUNTRIES))
PLACES_SRC = ("places_src", A.duckdb_sql(A.PLACES))

EPOCH = "cast(floor(epoch(extraction_timestamp)) as bigint) AS extraction_epoch"

REASON = """CASE WHEN n_fields < 17 THEN 'arity'
  WHEN bad_cast THEN 'bad_cast'
  WHEN longitude IS NULL OR latitude IS NULL THEN 'no_position' END"""

ACCEPTED = (
    "accepted",
    f"""SELECT event_id, trim(icao24) AS icao24, trim(callsign) AS callsign, trim(origin_country) AS origin_country,
  cast(time_position AS integer) AS time_position, cast(last_contact AS integer) AS last_contact,
  longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate, sensors, geo_altitude,
  trim(squawk) AS squawk, spi, position_source, extraction_timestamp
FROM states_src WHERE {REASON} IS NULL""",
)

DERIVED = """baro_altitude * 3.28084e0 AS altitude_ft, velocity * 1.94384e0 AS velocity_knots,
  vertical_rate * 196.85e0 AS vertical_rate_fpm,
  CASE WHEN on_ground THEN 'On Ground' WHEN NOT on_ground THEN 'Airborne' ELSE 'Unknown' END AS flight_status,
  longitude IS NOT NULL AND latitude IS NOT NULL AS has_position,
  baro_altitude IS NOT NULL AS has_altitude,
  cast(extraction_timestamp AS date) AS extraction_date"""

FLIGHTS = ("flights", f"SELECT *, {DERIVED} FROM states_src")


def _airports(limit: str) -> str:
    return f"""SELECT iata_code, coalesce(nullif(icao_code, ''), iata_code) AS icao_code,
  coalesce(nullif(name, ''), 'Unknown Airport') AS name, latitude_deg AS lat, longitude_deg AS lon,
  cast(trunc(elevation_ft) AS integer) AS elevation_ft,
  coalesce(nullif(municipality, ''), 'Unknown') AS municipality,
  coalesce(nullif(iso_country, ''), 'Unknown') AS country
FROM (SELECT * FROM airports_src
  WHERE latitude_deg IS NOT NULL AND longitude_deg IS NOT NULL AND scheduled_service
    AND iata_code IS NOT NULL AND iata_code <> ''
  ORDER BY name NULLS FIRST, iata_code {limit})
WHERE NOT (latitude_deg = 0 AND longitude_deg = 0)"""


FIRST_AIRPORTS = ("airports", _airports("LIMIT 500"))
AIRPORTS = ("airports", _airports(""))

OUTCOME = """CASE WHEN http_status IN (401, 403) THEN 'auth' WHEN http_status = 429 THEN 'rate_limited'
  WHEN http_status >= 400 THEN 'http_error' WHEN main_is_null THEN 'bad_payload' ELSE 'ok' END"""

OBSERVED = (
    "observed",
    """SELECT iata_code, timezone_offset, temp AS temperature, feels_like, humidity, pressure,
  clouds_all AS cloudiness, visibility, wind_speed, wind_deg AS wind_direction, wind_gust,
  CASE WHEN NOT weather_empty THEN weather_main END AS weather_main,
  CASE WHEN NOT weather_empty THEN weather_description END AS weather_description,
  CASE WHEN NOT weather_empty THEN weather_icon END AS weather_icon,
  nullif(sunrise, 0) AS sunrise_epoch, nullif(sunset, 0) AS sunset_epoch,
  cast(NULL AS varchar) AS timezone, cast(NULL AS double) AS dew_point, cast(NULL AS double) AS uvi
FROM weather_src WHERE http_status = 200 AND NOT main_is_null""",
)
WEATHER = (
    "weather",
    f"""SELECT a.iata_code AS airport_iata_code, icao_code AS airport_icao_code, name AS airport_name,
  municipality AS airport_municipality, country AS airport_country, lat AS latitude, lon AS longitude, elevation_ft,
  o.* EXCLUDE (iata_code), {RUN_EPOCH} AS extraction_epoch, {DAY} AS extraction_date
FROM airports a JOIN observed o ON a.iata_code = o.iata_code""",
)

KNOWN = (
    "known",
    "SELECT * FROM (VALUES " + ", ".join(f"('{code}', {pos})" for pos, code in enumerate(KNOWN_COUNTRIES)) + ") AS k(country_code, known_pos)",
)

CITIES = (
    "cities",
    "SELECT * FROM places_src WHERE place_type = 'CITY'",
)
PLACES = (
    "places",
    f"""SELECT cast(place_id AS integer) AS place_id, place_name, place_type, country_code, cast(NULL AS varchar) AS country_name,
  region, region_code, cast(cast(nullif(latitude, 0) AS float) AS double) AS latitude,
  cast(cast(nullif(longitude, 0) AS float) AS double) AS longitude,
  CASE WHEN population_missing THEN 0 ELSE population END AS population,
  cast(NULL AS integer) AS elevation_meters, cast(NULL AS varchar) AS timezone, {RUN_EPOCH} AS extraction_epoch
FROM cities WHERE country_code NOT IN (SELECT country_code FROM spoilt)""",
)
SPOILT = (
    "spoilt",
    """SELECT DISTINCT country_code FROM cities WHERE latitude IS NULL OR (population IS NULL AND NOT population_missing)""",
)
CATEGORISED = (
    "categorised",
    f"""SELECT *,
  CASE WHEN population IS NULL THEN 'Unknown' WHEN population < 100000 THEN 'Small' WHEN population < 500000 THEN 'Medium'
    WHEN population < 2000000 THEN 'Large' ELSE 'Metropolitan' END AS population_category,
  CASE WHEN population IS NULL THEN 'Unknown' WHEN population < 1000 THEN 'Small' WHEN population < 100000 THEN 'Medium'
    WHEN population < 1000000 THEN 'Large' ELSE 'Very High' END AS elevation_category,
  CASE WHEN latitude > 0 THEN 'Northern' WHEN latitude < 0 THEN 'Southern' ELSE 'Equatorial' END AS hemisphere,
  {DAY} AS extraction_date
FROM places""",
)
COUNTRIES = (
    "countries",
    f"""SELECT code AS country_code, name AS country_name, first_currency AS currency_code, continent,
  {RUN_EPOCH} AS extraction_epoch, {DAY} AS extraction_date
FROM countries_src""",
)


def _with(sql: str, *relations: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in relations) + "\n" + sql


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat, dlon = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    chord = f"{dlat} * {dlat} + cos(radians({lat1})) * cos(radians({lat2})) * {dlon} * {dlon}"
    return f"round(2 * 6371.0088e0 * asin(least(1.0e0, sqrt({chord}))), 3)"


def _near(radius: int) -> tuple[str, str]:
    return (
        "near",
        f"""SELECT * FROM (
  SELECT s.event_id, s.icao24, a.iata_code AS airport_iata_code, {_haversine("a.lat", "a.lon", "s.latitude", "s.longitude")} AS distance_km
  FROM states_src s CROSS JOIN airports a WHERE s.on_ground = false AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL
) WHERE distance_km <= {radius}""",
    )


def _nearby(radius: int) -> tuple[str, str]:
    return (
        "nearby",
        f"""SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY airport_iata_code ORDER BY distance_km, city_id) AS integer) AS rank
FROM (
  SELECT p.place_id AS city_id, p.place_name AS city_name, p.country_code, p.latitude, p.longitude, p.population,
    a.iata_code AS airport_iata_code, {_haversine("a.lat", "a.lon", "p.latitude", "p.longitude")} AS distance_km
  FROM places_src p CROSS JOIN airports a
  WHERE p.place_type = 'CITY' AND p.latitude IS NOT NULL AND p.longitude IS NOT NULL
) WHERE distance_km <= {radius}) WHERE rank <= 50""",
    )


STATIC = (
    "airports",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{row[0]}', {row[3]}e0, {row[4]}e0)" for row in STATIC_AIRPORTS)
    + ") AS t(iata_code, lat, lon)",
)


def _gate(dataset: str, metric: str, value: str, minimum: int | None, source: str) -> str:
    if minimum is None:
        threshold, passed = "cast(NULL AS double)", "cast(NULL AS boolean)"
    else:
        threshold, passed = f"cast({minimum} AS double)", f"{value} >= {minimum}"
    return f"""SELECT '{dataset}' AS dataset, '{metric}' AS metric, cast({value} AS double) AS value,
  {threshold} AS threshold, {passed} AS passed FROM {source} WHERE extraction_date = {DAY}"""


def _gate_flights(source: str) -> str:
    return _gate("flights", "record_count", "count(*)", 10, source)


GATE_WEATHER = "\nUNION ALL ".join(
    [
        _gate("weather", "record_count", "count(*)", 50, "weather"),
        _gate("weather", "unique_airports", "count(DISTINCT airport_iata_code)", 20, "weather"),
        _gate("weather", "avg_temperature", "round(coalesce(avg(temperature), 0), 6)", None, "weather"),
    ]
)
GATE_PLACES = "\nUNION ALL ".join(
    [
        _gate("places", "record_count", "count(*)", 50, "categorised"),
        _gate("places", "unique_countries", "count(DISTINCT country_code)", 10, "categorised"),
        _gate("places", "unique_place_types", "count(DISTINCT place_type)", None, "categorised"),
    ]
)

WEATHER_RELATIONS = (AIRPORTS_SRC, WEATHER_SRC, AIRPORTS, OBSERVED, WEATHER)
PLACES_RELATIONS = (PLACES_SRC, CITIES, SPOILT, PLACES, CATEGORISED)
# The countries wanted on the day: places of other countries are not written.
WANTED = (
    "wanted",
    """SELECT cast(row_number() OVER (ORDER BY is_match DESC, pos) AS integer) AS position, country_code, is_match FROM (
  SELECT k.country_code, true AS is_match, c.pos FROM known k JOIN listed c ON k.country_code = c.code
  UNION ALL
  SELECT k.country_code, false, k.known_pos FROM known k WHERE k.country_code NOT IN (SELECT code FROM listed)
) QUALIFY is_match OR position <= 10""",
)
LISTED = ("listed", "SELECT * FROM countries_src")

# Lists of places by range of ids, in pages of ten, an empty one behind full ones; those with a third page lack it in some way.
LANDED_PAGES = (
    (
        "listed_items",
        """SELECT *, row_number() OVER (PARTITION BY listing ORDER BY population, place_id) - 1 AS nth
FROM (SELECT *, cast(place_id // 150 AS varchar) AS listing FROM places_src)
WHERE place_type = 'CITY' AND population >= 10000""",
    ),
    (
        "listed_pages",
        """SELECT listing, count(*) // 10 + 1 AS pages,
  CASE WHEN count(*) // 10 + 1 >= 3 THEN CASE cast(listing AS integer) % 7 WHEN 1 THEN 'failed' WHEN 2 THEN 'unanswered'
    WHEN 3 THEN 'not_json' WHEN 4 THEN CASE WHEN count(*) // 10 + 1 = 3 THEN 'open' ELSE 'gap' END END END AS reason
FROM listed_items GROUP BY listing""",
    ),
)

LATEST_FLIGHTS = f"""SELECT * EXCLUDE (extraction_timestamp, nth), {EPOCH} FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY extraction_timestamp DESC, last_contact DESC, event_id DESC) AS nth
  FROM flights
) WHERE nth = 1"""

PER_DAY = """SELECT extraction_date, count(*) AS flights, count(altitude_ft) AS with_altitude,
  round(sum(velocity_knots), 3) AS sum_knots FROM flights GROUP BY extraction_date"""

ORACLE: dict[str, str] = {
    "q01_parse_states": _with(f"SELECT * EXCLUDE (extraction_timestamp), {EPOCH} FROM accepted", STATES_SRC, ACCEPTED),
    "q02_state_rejects": _with(
        "SELECT reject_reason, count(*) AS states FROM reasons WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
        STATES_SRC,
        ("reasons", f"SELECT {REASON} AS reject_reason FROM states_src"),
    ),
    "q03_airborne": _with(
        f"SELECT * EXCLUDE (extraction_timestamp), {EPOCH} FROM states_src WHERE on_ground = false", STATES_SRC
    ),
    "q04_enrich_flights": _with(f"SELECT * EXCLUDE (extraction_timestamp), {EPOCH} FROM flights", STATES_SRC, FLIGHTS),
    "q05_airports": _with("SELECT * FROM airports", AIRPORTS_SRC, FIRST_AIRPORTS),
    "q06_static_airports": _with(
        """SELECT airport_iata_code, count(*) AS flights, min(distance_km) AS nearest_km, max(distance_km) AS farthest_km
FROM near GROUP BY airport_iata_code""",
        STATES_SRC,
        STATIC,
        _near(500),
    ),
    "q07_parse_weather": _with("SELECT * FROM observed", WEATHER_SRC, OBSERVED),
    "q08_airport_weather": _with("SELECT * FROM weather", *WEATHER_RELATIONS),
    "q09_fetch_outcomes": _with(
        "SELECT outcome, count(*) AS fetches FROM outcomes GROUP BY outcome",
        WEATHER_SRC,
        ("outcomes", f"SELECT {OUTCOME} AS outcome FROM weather_src"),
    ),
    "q10_countries": _with("SELECT * FROM countries", COUNTRIES_SRC, COUNTRIES),
    "q11_target_countries": _with("SELECT * FROM wanted", COUNTRIES_SRC, LISTED, KNOWN, WANTED),
    "q12_parse_places": _with("SELECT * FROM places", PLACES_SRC, CITIES, SPOILT, PLACES),
    "q13_enrich_places": _with("SELECT * FROM categorised", *PLACES_RELATIONS),
    "q14_place_list": _with(
        f"""SELECT cast(place_id AS integer) AS place_id, place_name, place_type, country_code, cast(NULL AS varchar) AS country_name,
  region, region_code, latitude, longitude, population, {RUN_EPOCH} AS extraction_epoch
FROM places_src WHERE place_type = 'CITY' AND population >= 10000""",
        PLACES_SRC,
    ),
    "q15_location_key": _with(
        """SELECT c_custkey, printf('%+.4f%+.4f', (c_custkey * 7919 % 18000000) / 100000.0e0 - 90.0e0,
  (c_custkey * 104729 % 36000000) / 100000.0e0 - 180.0e0) AS location_key
FROM airports_src""",
        AIRPORTS_SRC,
    ),
    "q16_gate_flights": _with(_gate_flights("flights"), STATES_SRC, FLIGHTS),
    "q17_gate_weather": _with(GATE_WEATHER, *WEATHER_RELATIONS),
    "q18_gate_places": _with(GATE_PLACES, *PLACES_RELATIONS),
    "q19_gate_all": _with(
        """SELECT dataset, bool_and(passed) AS passed, count(threshold) AS checks FROM gates GROUP BY dataset
UNION ALL SELECT 'all', bool_and(passed), count(threshold) FROM gates""",
        STATES_SRC,
        FLIGHTS,
        *WEATHER_RELATIONS,
        *PLACES_RELATIONS,
        ("gates", "\nUNION ALL ".join([_gate_flights("flights"), GATE_WEATHER, GATE_PLACES])),
    ),
    "q20_flights_near_airport": _with("SELECT * FROM near", STATES_SRC, AIRPORTS_SRC, AIRPORTS, _near(200)),
    "q21_nearby_places": _with("SELECT * FROM nearby", PLACES_SRC, AIRPORTS_SRC, AIRPORTS, _nearby(1000)),
    "q22_current_flights": _with(LATEST_FLIGHTS, STATES_SRC, FLIGHTS),
    "q23_day_partitions": _with(PER_DAY, STATES_SRC, FLIGHTS),
    "q24_replace_day": _with(PER_DAY, STATES_SRC, FLIGHTS),
    "q25_stream_ingest": _with(
        """SELECT icao24, last_contact, origin_country, latitude, longitude, altitude_ft, squawk, extraction_date FROM (
  SELECT DISTINCT * EXCLUDE (event_id, extraction_timestamp), baro_altitude * 3.28084e0 AS altitude_ft,
    cast(extraction_timestamp AS date) AS extraction_date FROM accepted
)""",
        STATES_SRC,
        ACCEPTED,
    ),
    "q26_parse_nearby": _with(
        f"""SELECT airport_iata_code, cast(city_id AS varchar) AS city_id, city_name, country_code, latitude, longitude,
  cast(population AS bigint) AS population,
  distance_km, {RUN_EPOCH} AS extraction_epoch FROM nearby""",
        PLACES_SRC,
        AIRPORTS_SRC,
        AIRPORTS,
        _nearby(50),
    ),
    "q27_reject_rows": _with(
        "SELECT * FROM reasons WHERE reject_reason IS NOT NULL",
        STATES_SRC,
        ("reasons", f"SELECT event_id, {REASON} AS reject_reason, icao24 FROM states_src"),
    ),
    "q28_daily_run": _with(
        "\nUNION ALL ".join([_gate_flights("written_flights"), GATE_WEATHER, GATE_PLACES]),
        STATES_SRC,
        ACCEPTED,
        ("written_flights", "SELECT cast(extraction_timestamp AS date) AS extraction_date FROM accepted"),
        *WEATHER_RELATIONS,
        COUNTRIES_SRC,
        LISTED,
        KNOWN,
        WANTED,
        PLACES_SRC,
        CITIES,
        SPOILT,
        (PLACES[0], f"{PLACES[1]} AND country_code IN (SELECT country_code FROM wanted)"),
        CATEGORISED,
    ),
    "q29_day_tables": _with(
        """SELECT how, dataset, key, text, extraction_date FROM (
  SELECT 'current_weather' AS dataset, airport_iata_code AS key, airport_name AS text, extraction_date FROM weather
  UNION ALL SELECT 'geography_places', cast(place_id AS varchar), population_category, extraction_date FROM categorised
  UNION ALL SELECT 'geography_countries', country_code, country_name, extraction_date FROM countries
), (VALUES ('appended'), ('appended'), ('replaced')) AS runs(how)""",
        *WEATHER_RELATIONS,
        *PLACES_RELATIONS,
        COUNTRIES_SRC,
        COUNTRIES,
    ),
    "q30_current_weather": _with(
        f"""SELECT airport_iata_code, cloudiness,
  CASE WHEN cloudiness < 50 THEN {RUN_EPOCH} ELSE {EARLIER_EPOCH} END AS extraction_epoch,
  CASE WHEN cloudiness < 50 THEN {DAY} ELSE DATE '2024-01-14' END AS extraction_date
FROM weather""",
        *WEATHER_RELATIONS,
    ),
    "q31_flights_near_all_airports": _with("SELECT * FROM near", STATES_SRC, AIRPORTS_SRC, AIRPORTS, _near(100)),
    "q32_airport_outcomes": _with(
        f"""SELECT {OUTCOME} AS outcome, count(*) AS fetches
FROM airports a JOIN weather_src w ON a.iata_code = w.iata_code GROUP BY outcome""",
        AIRPORTS_SRC,
        WEATHER_SRC,
        AIRPORTS,
    ),
    "q33_flights_table": _with(
        f"SELECT * EXCLUDE (event_id, extraction_timestamp), {EPOCH}, {DERIVED} FROM accepted", STATES_SRC, ACCEPTED
    ),
    "q34_rejected_places": _with(
        f"""SELECT country_code, cast(place_id AS integer) AS place_id, place_name, 'bad_country' AS reject_reason,
  {RUN_EPOCH} AS extraction_epoch
FROM cities WHERE country_code IN (SELECT country_code FROM spoilt)""",
        PLACES_SRC,
        CITIES,
        SPOILT,
    ),
    "q35_failed_weather": _with(
        f"SELECT * FROM (SELECT iata_code, {OUTCOME} AS outcome FROM weather_src) WHERE outcome <> 'ok'", WEATHER_SRC
    ),
    "q40_rejected_nearby": _with(
        """SELECT airport_iata_code, cast(city_id AS varchar) AS city_id, city_name, 'bad_cast' AS reject_reason
FROM nearby WHERE airport_iata_code LIKE '%0'""",
        PLACES_SRC,
        AIRPORTS_SRC,
        AIRPORTS,
        _nearby(50),
    ),
    "q41_daily_rejects": _with(
        f"""SELECT 'flights' AS relation, CASE WHEN event_id % 50 = 0 THEN 'unreadable' ELSE {REASON} END AS reject_reason,
  CASE WHEN event_id % 50 <> 0 THEN icao24 END AS key
FROM states_src WHERE event_id % 50 = 0 OR {REASON} IS NOT NULL
UNION ALL
SELECT 'weather', outcome, iata_code
FROM (SELECT iata_code, {OUTCOME} AS outcome FROM weather_src WHERE iata_code IN (SELECT iata_code FROM airports))
WHERE outcome <> 'ok'
UNION ALL
SELECT 'places', 'bad_country', cast(place_id AS varchar) FROM cities
WHERE country_code IN (SELECT country_code FROM spoilt) AND country_code IN (SELECT country_code FROM wanted)""",
        STATES_SRC,
        AIRPORTS_SRC,
        WEATHER_SRC,
        AIRPORTS,
        COUNTRIES_SRC,
        LISTED,
        KNOWN,
        WANTED,
        PLACES_SRC,
        CITIES,
        SPOILT,
    ),
    "q42_null_sections": _with(
        """SELECT iata_code, CASE WHEN http_status IN (401, 403) THEN 'auth' WHEN http_status = 429 THEN 'rate_limited'
  WHEN http_status >= 400 THEN 'http_error'
  WHEN main_is_null OR right(iata_code, 1) IN ('1', '2', '3', '4') THEN 'bad_payload' ELSE 'ok' END AS outcome
FROM weather_src""",
        WEATHER_SRC,
    ),
    "q36_void_listings": _with(
        "SELECT listing, reason AS void_reason FROM listed_pages WHERE reason IS NOT NULL",
        PLACES_SRC,
        *LANDED_PAGES,
    ),
    "q37_whole_listings": _with(
        """SELECT cast(place_id AS integer) AS place_id, place_name, population FROM listed_items JOIN listed_pages USING (listing)
WHERE reason IS NULL""",
        PLACES_SRC,
        *LANDED_PAGES,
    ),
    "q43_top_places": _with(
        """SELECT country_code, cast(place_id AS integer) AS place_id, place_name,
  CASE WHEN population_missing THEN 0 ELSE population END AS population,
  CASE WHEN country_code IN (SELECT country_code FROM first_spoilt) THEN 'bad_country' END AS reject_reason
FROM first_cities""",
        PLACES_SRC,
        (
            "first_cities",
            """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY place_id) AS place FROM places_src)
WHERE place <= 10 AND place_type = 'CITY'""",
        ),
        (
            "first_spoilt",
            "SELECT country_code FROM first_cities WHERE latitude IS NULL OR (population IS NULL AND NOT population_missing)",
        ),
    ),
    "q44_missing_pages": _with(
        """SELECT listing, 20 AS page_offset, reason FROM listed_pages WHERE reason IS NOT NULL
UNION ALL
SELECT concat('more ', max(place_id) + unnest([0, 1])), 0, 'open' FROM places_src""",
        PLACES_SRC,
        *LANDED_PAGES,
    ),
    "q45_rejected_place_list": _with(
        """SELECT listing, cast(nth // 10 * 10 AS integer) AS page_offset,
  CASE WHEN nth // 10 % 4 < 3 THEN cast(place_id AS integer) END AS place_id,
  CASE WHEN nth // 10 % 4 < 3 THEN place_name END AS place_name,
  CASE WHEN nth // 10 % 4 < 3 THEN 'bad_cast' ELSE 'bad_item' END AS reject_reason
FROM listed_items WHERE nth // 10 % 4 IN (1, 2) OR (nth // 10 % 4 = 3 AND nth % 10 = 0)""",
        PLACES_SRC,
        *LANDED_PAGES,
    ),
    "q46_stream_sinks": _with(
        f"""SELECT 'flights' AS sink, cast(NULL AS varchar) AS reject_reason, icao24, extraction_date FROM (
  SELECT DISTINCT * EXCLUDE (event_id, extraction_timestamp), cast(extraction_timestamp AS date) AS extraction_date
  FROM accepted WHERE event_id % 50 <> 0
)
UNION ALL
SELECT 'rejects', reject_reason, icao24, cast(extraction_timestamp AS date) FROM (
  SELECT DISTINCT * EXCLUDE (event_id), {REASON} AS reject_reason FROM states_src WHERE event_id % 50 <> 0 AND {REASON} IS NOT NULL
)
UNION ALL
SELECT 'rejects', 'unreadable', NULL, cast(extraction_timestamp AS date)
FROM (SELECT DISTINCT extraction_timestamp FROM states_src WHERE event_id % 50 = 0)""",
        STATES_SRC,
        ACCEPTED,
    ),
    "q47_hourly_snapshots": _with(
        """SELECT * EXCLUDE (event_id, extraction_timestamp),
  cast(floor(epoch(date_trunc('hour', extraction_timestamp))) AS bigint) AS extraction_epoch FROM accepted""",
        STATES_SRC,
        ACCEPTED,
    ),
    "q48_incremental_view": _with(LATEST_FLIGHTS, STATES_SRC, FLIGHTS),
    "q49_nearest_places": _with("SELECT * FROM nearby", PLACES_SRC, AIRPORTS_SRC, AIRPORTS, _nearby(1000)),
    "q50_run_ledger": _with(
        """SELECT airport_iata_code, temperature, extraction_date, run_id
FROM weather, (VALUES ('early'), ('late')) AS runs(run_id)""",
        *WEATHER_RELATIONS,
    ),
    "q51_audited_run": _with(
        """SELECT 'current_weather' AS dataset,
  CASE WHEN (SELECT count(*) >= 50 AND count(DISTINCT airport_iata_code) >= 20 FROM weather)
    THEN 'published' ELSE 'staged' END AS kept, airport_iata_code AS key FROM weather
UNION ALL
SELECT 'geography_places',
  CASE WHEN (SELECT count(*) >= 50 AND count(DISTINCT country_code) >= 10 FROM categorised)
    THEN 'published' ELSE 'staged' END, cast(place_id AS varchar) FROM categorised
UNION ALL
SELECT 'geography_countries', 'published', country_code FROM countries""",
        *WEATHER_RELATIONS,
        COUNTRIES_SRC,
        COUNTRIES,
        LISTED,
        KNOWN,
        WANTED,
        PLACES_SRC,
        CITIES,
        SPOILT,
        (PLACES[0], f"{PLACES[1]} AND country_code IN (SELECT country_code FROM wanted)"),
        CATEGORISED,
    ),
    "q52_distinct_over_days": _with(
        """SELECT window_end, count(DISTINCT icao24) AS aircraft, true AS estimate_within_bound
FROM (SELECT DISTINCT extraction_date AS window_end FROM flights)
JOIN flights ON extraction_date BETWEEN window_end - 6 AND window_end GROUP BY window_end""",
        STATES_SRC,
        FLIGHTS,
    ),
    "q53_variant_states": _with(f"SELECT * EXCLUDE (extraction_timestamp), {EPOCH} FROM accepted", STATES_SRC, ACCEPTED),
    "q54_variant_weather": _with("SELECT * FROM observed", WEATHER_SRC, OBSERVED),
    "q38_empty_day": _with(
        "\nUNION ALL ".join(
            [
                _gate_flights("no_flights"),
                GATE_WEATHER.replace("FROM weather", "FROM no_weather"),
                GATE_PLACES.replace("FROM categorised", "FROM no_places"),
            ]
        ),
        *WEATHER_RELATIONS,
        *PLACES_RELATIONS,
        ("no_flights", f"SELECT {DAY} AS extraction_date WHERE false"),
        ("no_weather", "SELECT * FROM weather WHERE false"),
        ("no_places", "SELECT * FROM categorised WHERE false"),
    ),
    "q39_row_counts": _with(
        """SELECT 'flights' AS dataset, (SELECT count(*) FROM accepted) AS written
UNION ALL SELECT 'weather', (SELECT count(*) FROM weather)
UNION ALL SELECT 'places', (SELECT count(*) FROM categorised)
UNION ALL SELECT 'countries', (SELECT count(*) FROM countries)""",
        STATES_SRC,
        ACCEPTED,
        *WEATHER_RELATIONS,
        COUNTRIES_SRC,
        COUNTRIES,
        LISTED,
        KNOWN,
        WANTED,
        PLACES_SRC,
        CITIES,
        SPOILT,
        (PLACES[0], f"{PLACES[1]} AND country_code IN (SELECT country_code FROM wanted)"),
        CATEGORISED,
    ),
}
