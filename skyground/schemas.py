"""Relations the package reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# --- fixed values -----------------------------------------------------------
# Allow-list of country codes, in order of preference.
KNOWN_COUNTRIES = [
    "US", "GB", "FR", "DE", "IT", "ES", "NL", "JP", "CN", "IN", "AF", "BR", "MX", "CA", "AU",
]

# Airports used when the airports table cannot be read.
STATIC_AIRPORTS = [
    ("JFK", "KJFK", "John F. Kennedy International Airport", 40.6413, -73.7781, None, "New York", "US"),
    ("LAX", "KLAX", "Los Angeles International Airport", 33.9425, -118.4081, None, "Los Angeles", "US"),
    ("LHR", "EGLL", "London Heathrow Airport", 51.47, -0.4543, None, "London", "GB"),
    ("CDG", "LFPG", "Charles de Gaulle Airport", 49.0097, 2.5479, None, "Paris", "FR"),
    ("NRT", "RJAA", "Narita International Airport", 35.772, 140.3928, None, "Tokyo", "JP"),
]
# ----------------------------------------------------------------------------

# A landed document: what a fetch stored, next to the time of the run.
LANDING = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
    ]
)

# --- fixed values: columns and types of the output relations ------------------
AIRPORT_INFO = T.StructType(
    [
        T.StructField("iata_code", T.StringType()),
        T.StructField("icao_code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("elevation_ft", T.IntegerType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

CURRENT_FLIGHTS = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("time_position", T.IntegerType()),
        T.StructField("last_contact", T.IntegerType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
        T.StructField("sensors", T.StringType()),
        T.StructField("geo_altitude", T.DoubleType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("spi", T.BooleanType()),
        T.StructField("position_source", T.IntegerType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("altitude_ft", T.DoubleType()),
        T.StructField("velocity_knots", T.DoubleType()),
        T.StructField("vertical_rate_fpm", T.DoubleType()),
        T.StructField("flight_status", T.StringType()),
        T.StructField("has_position", T.BooleanType()),
        T.StructField("has_altitude", T.BooleanType()),
        T.StructField("extraction_date", T.DateType()),
    ]
)

# What is kept of a state that was rejected.
FLIGHT_REJECTS = T.StructType(
    [
        T.StructField("reject_reason", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("extraction_date", T.DateType()),
    ]
)

CURRENT_WEATHER = T.StructType(
    [
        T.StructField("airport_iata_code", T.StringType()),
        T.StructField("airport_icao_code", T.StringType()),
        T.StructField("airport_name", T.StringType()),
        T.StructField("airport_municipality", T.StringType()),
        T.StructField("airport_country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation_ft", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_offset", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("pressure", T.IntegerType()),
        T.StructField("dew_point", T.DoubleType()),
        T.StructField("uvi", T.DoubleType()),
        T.StructField("cloudiness", T.IntegerType()),
        T.StructField("visibility", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.IntegerType()),
        T.StructField("wind_gust", T.DoubleType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("weather_description", T.StringType()),
        T.StructField("weather_icon", T.StringType()),
        T.StructField("sunrise", T.TimestampType()),
        T.StructField("sunset", T.TimestampType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("extraction_date", T.DateType()),
    ]
)

GEOGRAPHY_PLACES = T.StructType(
    [
        T.StructField("place_id", T.IntegerType()),
        T.StructField("place_name", T.StringType()),
        T.StructField("place_type", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("population", T.IntegerType()),
        T.StructField("elevation_meters", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("population_category", T.StringType()),
        T.StructField("elevation_category", T.StringType()),
        T.StructField("hemisphere", T.StringType()),
        T.StructField("extraction_date", T.DateType()),
    ]
)

GEOGRAPHY_COUNTRIES = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("extraction_date", T.DateType()),
    ]
)
# ----------------------------------------------------------------------------


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order; raise when a name or type differs."""
    types = {field.name: field.dataType for field in df.schema.fields}
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, got {types.get(field.name)}"
        for field in schema.fields
        if types.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*schema.fieldNames())


def known_countries(spark: SparkSession) -> DataFrame:
    """The allow-list as (country_code, known_pos)."""
    rows = [(code, pos) for pos, code in enumerate(KNOWN_COUNTRIES)]
    return spark.createDataFrame(rows, "country_code string, known_pos int")


def static_airports(spark: SparkSession) -> DataFrame:
    """The five literal airports in normalised form."""
    return spark.createDataFrame(STATIC_AIRPORTS, AIRPORT_INFO)
