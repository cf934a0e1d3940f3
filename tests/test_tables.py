from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from skyground.operators.current import current_flights, current_weather
from skyground.schemas import CURRENT_FLIGHTS, conform
from skyground.session import pin_session, shared_folder
from skyground.sources.landing import read_documents, read_landing
from skyground.sources.tables import append_by_day, replace_day

ROWS = [("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 2))]
SCHEMA = "name string, extraction_date date"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, path):
    return sorted((r.name, r.extraction_date.day) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("compact", [False, True])
def test_append(spark, tmp_path, compact):
    path = f"{tmp_path}/t"
    assert append_by_day(frame(spark), path, compact=compact) == 3
    assert append_by_day(frame(spark), path, compact=compact) == 3
    assert spark.read.parquet(path).count() == 6
    assert sorted(p.name for p in (tmp_path / "t").glob("extraction_date=*")) == ["extraction_date=2024-01-01", "extraction_date=2024-01-02"]


@pytest.mark.parametrize("compact", [False, True])
def test_replace_touches_only_its_days(spark, tmp_path, compact):
    path = f"{tmp_path}/t"
    for _ in range(2):
        assert replace_day(frame(spark), path, compact=compact) == 3
    assert replace_day(frame(spark, [("z", dt.date(2024, 1, 2))]), path, compact=compact) == 1
    assert stored(spark, path) == [("a", 1), ("b", 1), ("z", 2)]


def test_append_of_nothing(spark, tmp_path):
    assert append_by_day(frame(spark, []), f"{tmp_path}/t") == 0


def test_day_filter_prunes_partitions(spark, tmp_path):
    from skyground.operators.quality import for_day

    append_by_day(frame(spark), f"{tmp_path}/t")
    plan = for_day(spark.read.parquet(f"{tmp_path}/t"), dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extraction_date" in plan


def test_latest_flight(spark):
    rows = [("a", 1, 5, "old"), ("a", 2, 4, "less recent contact"), ("a", 2, 6, "new"), ("b", 1, None, "no contact"), ("b", 1, 1, "contact")]
    df = spark.createDataFrame(rows, "icao24 string, at int, last_contact int, note string").withColumn(
        "extraction_timestamp", F.timestamp_seconds("at")
    )
    assert sorted(r.note for r in current_flights(df).collect()) == ["contact", "new"]
    # Each task passes on one row per key, however many it has.
    assert "WindowGroupLimit" in current_flights(df)._jdf.queryExecution().executedPlan().toString()


def test_latest_weather(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "airport_iata_code string, at int").withColumn(
        "extraction_timestamp", F.timestamp_seconds("at")
    )
    assert sorted((r.airport_iata_code, r.at) for r in current_weather(df).collect()) == [("A", 2), ("B", 1)]


def test_conform_names_the_difference(spark):
    with pytest.raises(ValueError, match="icao24: expected string, got"):
        conform(spark.createDataFrame([(1,)], "icao24 int"), CURRENT_FLIGHTS)


def test_readers(spark, tmp_path):
    (tmp_path / "docs.txt").write_text('{"states":[]}\n{"states":null}\n')
    docs = read_documents(spark, f"{tmp_path}/docs.txt", dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone.utc))
    assert docs.count() == 2
    assert docs.selectExpr("unix_timestamp(extraction_timestamp) AS at").first().at == 1704164400
    (tmp_path / "landing.json").write_text('{"iata_code":"JFK","http_status":200,"payload":"{}"}\n')
    landed = read_landing(spark, f"{tmp_path}/landing.json", "iata_code string, http_status int, payload string", "json")
    assert tuple(landed.first()) == ("JFK", 200, "{}")


def _session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master))


def test_shared_folder(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    shared = {"spark.checkpoint.dir": "hdfs://data/shared/"}
    assert shared_folder(_session("yarn", **shared), "x").startswith("hdfs://data/shared/x-")
    with pytest.raises(ValueError):
        shared_folder(_session("yarn"), "x")


def test_pin_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert pin_session(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_rows_without_a_key_are_kept(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 2), ("a", 1), ("a", 2)], "airport_iata_code string, at int"
    ).withColumn("extraction_timestamp", F.timestamp_seconds("at"))
    got = sorted((r.airport_iata_code or "", r["at"]) for r in current_weather(df).collect())
    assert got == [("", 1), ("", 2), ("a", 2)]


def test_only_a_missing_table_gives_the_static_airports(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from skyground.sources.airports import airports_or_static

    assert airports_or_static(spark, f"{tmp_path}/none").count() == 5
    spark.range(1).write.parquet(f"{tmp_path}/other")
    with pytest.raises(AnalysisException):
        airports_or_static(spark, f"{tmp_path}/other")


def test_location_keys_round_the_exact_value(spark):
    import random

    from skyground.functions.text import location_key

    draw = random.Random(4)
    places = [
        (round(draw.uniform(-90, 90), 5), round(draw.uniform(-180, 180), 5)) for _ in range(20_000)
    ]
    places += [(125.07615, -0.00005), (-0.0, 0.0), (0.00005, -0.000049), (0.5, -0.03125), (89.99995, -179.99995), (1e9, 1e22)]
    df = spark.createDataFrame(places, "lat double, lon double")
    got = df.select("lat", "lon", location_key(F.col("lat"), F.col("lon")).alias("key")).collect()
    wrong = [r for r in got if r.key != f"{r.lat:+.4f}{r.lon:+.4f}"]
    assert not wrong
    assert spark.range(1).select(location_key(F.lit(None), F.lit(1.0))).first()[0] is None
