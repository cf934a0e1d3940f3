"""The test tables seen as flights, airports, weather, countries and places.

The same SQL text runs on Spark and DuckDB; ``{EPOCH}`` and ``{TS}`` are the
only dialect tokens, and table names stand in braces. The modulus arms plant edge cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyground.sources.tables import spread

# --- fixed values: adapter SQL -----------------------------------------------
STATES = """
SELECT event_id,
  lpad(lower(hex(user_id)), 6, '0') AS icao24,
  rpad(upper(event_type), 8, ' ') AS callsign,
  concat('NATION_', cast(user_id % 25 AS string)) AS origin_country,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE {EPOCH} END AS time_position,
  {EPOCH} + event_id % 10 AS last_contact,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id * 37 % 36000) / 100.0e0 - 180.0e0 END AS longitude,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE (event_id * 53 % 18000) / 100.0e0 - 90.0e0 END AS latitude,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * 25.0e0 END AS baro_altitude,
  CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS on_ground,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE value END AS velocity,
  cast(event_id % 360 AS double) AS true_track,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 41 - 20) / 2.0e0 END AS vertical_rate,
  cast(NULL AS string) AS sensors,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * 26.0e0 END AS geo_altitude,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE lpad(cast(event_id % 7777 AS string), 4, '0') END AS squawk,
  event_id % 50 = 0 AS spi,
  cast(event_id % 4 AS int) AS position_source,
  CASE WHEN event_id % 29 = 0 THEN 16 ELSE 17 END AS n_fields,
  event_id % 31 = 0 AS bad_cast,
  {TS} AS extraction_timestamp
FROM {events}
"""

AIRPORTS = """
SELECT c_custkey,
  CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('A', cast(c_custkey AS string)) END AS iata_code,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('K', cast(c_custkey AS string)) END AS icao_code,
  CASE c_custkey % 31 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS name,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 0.0e0 ELSE (c_custkey * 53 % 18000) / 100.0e0 - 90.0e0 END AS latitude_deg,
  CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 0.0e0 ELSE (c_custkey * 37 % 36000) / 100.0e0 - 180.0e0 END AS longitude_deg,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS elevation_ft,
  CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END AS municipality,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE concat('NATION_', cast(c_nationkey AS string)) END AS iso_country,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey % 3 <> 0 END AS scheduled_service
FROM {customer}
"""

WEATHER = """
SELECT c_custkey,
  concat('A', cast(c_custkey AS string)) AS iata_code,
  CASE WHEN c_custkey % 43 = 0 THEN 401 WHEN c_custkey % 44 = 0 THEN 429 WHEN c_custkey % 46 = 0 THEN 500 ELSE 200 END AS http_status,
  c_custkey % 47 = 0 AS main_is_null,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal / 100.0e0 END AS temp,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal / 100.0e0 - 1.5e0 END AS feels_like,
  cast(c_custkey % 101 AS int) AS humidity,
  cast(950 + c_custkey % 100 AS int) AS pressure,
  cast(c_custkey % 100 AS int) AS clouds_all,
  CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE cast(c_custkey % 10000 AS int) END AS visibility,
  (c_custkey % 300) / 10.0e0 AS wind_speed,
  cast(c_custkey % 360 AS int) AS wind_deg,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE (c_custkey % 400) / 10.0e0 END AS wind_gust,
  c_custkey % 8 = 0 AS weather_empty,
  c_mktsegment AS weather_main,
  lower(c_mktsegment) AS weather_description,
  '01d' AS weather_icon,
  cast(CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 10 = 0 THEN NULL ELSE 1700000000 + c_custkey END AS bigint) AS sunrise,
  cast(CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE 1700040000 + c_custkey END AS bigint) AS sunset,
  cast((c_custkey % 25 - 12) * 3600 AS int) AS timezone_offset
FROM {customer}
"""

COUNTRIES = """
SELECT n_nationkey AS pos,
  CASE n_nationkey WHEN 0 THEN 'AD' WHEN 1 THEN 'AE' WHEN 2 THEN 'AF' WHEN 3 THEN 'AG' WHEN 4 THEN 'AI'
    WHEN 5 THEN 'AL' WHEN 6 THEN 'AM' WHEN 7 THEN 'AO' WHEN 8 THEN 'AR' WHEN 9 THEN 'AT' WHEN 10 THEN 'AU'
    WHEN 11 THEN 'AZ' WHEN 12 THEN 'BA' WHEN 13 THEN 'BB' WHEN 14 THEN 'BR' WHEN 15 THEN 'CA'
    ELSE concat('Z', cast(n_nationkey AS string)) END AS code,
  n_name AS name,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE concat('C', cast(n_nationkey AS string)) END AS first_currency,
  r_name AS continent,
  cast(floor(n_nationkey / 10) * 10 AS int) AS page_offset
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

PLACES = """
SELECT p_partkey AS place_id,
  p_name AS place_name,
  CASE WHEN p_partkey % 4 = 3 THEN 'ADM2' ELSE 'CITY' END AS place_type,
  CASE p_partkey % 15 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'FR' WHEN 3 THEN 'DE' WHEN 4 THEN 'IT'
    WHEN 5 THEN 'ES' WHEN 6 THEN 'NL' WHEN 7 THEN 'JP' WHEN 8 THEN 'CN' WHEN 9 THEN 'IN' WHEN 10 THEN 'AF'
    WHEN 11 THEN 'BR' WHEN 12 THEN 'MX' WHEN 13 THEN 'CA' ELSE 'AU' END AS country_code,
  p_brand AS region,
  concat('R', cast(p_size AS string)) AS region_code,
  CASE WHEN p_partkey = 28 THEN NULL WHEN p_partkey % 21 = 0 THEN 0.0e0 ELSE (p_partkey * 53 % 18000) / 100.0e0 - 90.0e0 END AS latitude,
  CASE WHEN p_partkey % 33 = 0 THEN NULL ELSE (p_partkey * 37 % 36000) / 100.0e0 - 180.0e0 END AS longitude,
  CASE WHEN p_partkey IN (27, 44) THEN NULL WHEN p_partkey % 25 = 0 THEN 0 ELSE cast(p_partkey * 7919 % 3000000 AS int) END AS population,
  p_partkey % 25 = 0 AS population_missing
FROM {part}
"""
# ------------------------------------------------------------------------------

_SPARK = {"{EPOCH}": "unix_timestamp(cast(ts as timestamp))", "{TS}": "cast(ts as timestamp)"}
_DUCKDB = {"{EPOCH}": "cast(floor(epoch(ts)) as bigint)", "{TS}": "ts"}
_TABLES = ["events", "customer", "part", "nation", "region"]


def duckdb_sql(sql: str) -> str:
    """The adapter as DuckDB SQL over the registered views."""
    for token, text in {**_DUCKDB, **{f"{{{name}}}": name for name in _TABLES}}.items():
        sql = sql.replace(token, text)
    return sql.strip()


def adapter(spark: SparkSession, sf_dir: str, sql: str, even: bool = False) -> DataFrame:
    """The adapter as a DataFrame over the parquet files of one scale factor; ``even`` deals their rows over the cores."""
    for token, text in _SPARK.items():
        sql = sql.replace(token, text)
    used = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _TABLES if f"{{{name}}}" in sql}
    if even:
        used = {name: spread(table) for name, table in used.items()}
    return spark.sql(sql, **used)
