from __future__ import annotations

import datetime as dt
import json

import pytest

from skyground.functions.time import utc_timestamp
from skyground.operators import airports as A, weather as O
from skyground.operators.fetches import fetch_outcomes
from skyground.plans import weather as P
from skyground.schemas import AIRPORT_INFO, static_airports
from skyground.sources.airports import airports_or_static

DOC = {
    "main": {"temp": 12.5, "feels_like": 11, "humidity": 80, "pressure": 1013},
    "weather": [{"main": "Rain", "description": "light rain", "icon": "10d"}, {"main": "Snow"}],
    "wind": {"speed": 3, "deg": 200, "gust": 7.5},
    "clouds": {"all": 90},
    "sys": {"sunrise": 1700000000, "sunset": 1700040000},
    "visibility": 10000,
    "timezone": -3600,
}
RUN_AT = dt.datetime(2024, 1, 2, 3, 30, tzinfo=dt.timezone.utc)


def doc(**parts):
    return {**DOC, **parts}


def without(*names):
    return {name: part for name, part in DOC.items() if name not in names}


def parse(spark, *documents, status=200):
    rows = [("JFK", status, d if isinstance(d, str) or d is None else json.dumps(d)) for d in documents]
    return O.parse_weather(spark.createDataFrame(rows, "iata_code string, http_status int, payload string")).collect()


def outcome(spark, document):
    return parse(spark, document)[0].outcome


def test_values(spark):
    row = parse(spark, DOC)[0]
    assert row.outcome == "ok"
    assert (row.temperature, row.feels_like, row.humidity, row.pressure) == (12.5, 11.0, 80, 1013)
    assert (row.wind_speed, row.wind_direction, row.wind_gust, row.cloudiness) == (3.0, 200, 7.5, 90)
    assert (row.weather_main, row.weather_description, row.weather_icon) == ("Rain", "light rain", "10d")
    assert (row.visibility, row.timezone_offset) == (10000, -3600)
    assert (row.timezone, row.dew_point, row.uvi) == (None, None, None)


@pytest.mark.parametrize("name", ["main", "wind", "clouds", "sys"])
def test_sections(spark, name):
    good, *bad = (parse(spark, without(name), *[doc(**{name: v}) for v in (None, [], "x", 5)]))
    assert good.outcome == "ok"
    assert [r.outcome for r in bad] == ["bad_payload"] * 4


def test_everything_missing_is_fine(spark):
    row = parse(spark, {})[0]
    assert row.outcome == "ok"
    assert all(row[name] is None for name in row.asDict() if name not in ("iata_code", "outcome"))


@pytest.mark.parametrize("payload", ["{bad", "[1]", "null", "7", None])
def test_no_object(spark, payload):
    assert outcome(spark, payload) == "bad_payload"


@pytest.mark.parametrize("value, expected", [(None, "ok"), ([], "ok"), ({}, "ok"), ("", "ok"), (0, "ok"), ([{}], "ok"), ([None], "bad_payload"), (["x"], "bad_payload"), ({"a": 1}, "bad_payload"), ("x", "bad_payload")])
def test_conditions(spark, value, expected):
    row = parse(spark, doc(weather=value))[0]
    assert (row.outcome, row.weather_main) == (expected, None)


@pytest.mark.parametrize("value, expected", [("12.5", 12.5), (None, None), (True, 1.0), (1e3, 1000.0)])
def test_temperature(spark, value, expected):
    row = parse(spark, doc(main={"temp": value}))[0]
    assert (row.outcome, row.temperature) == ("ok", expected)


@pytest.mark.parametrize("value", ["x", "", [1], {}, "1.5d"])
def test_bad_temperature(spark, value):
    assert outcome(spark, doc(main={"temp": value})) == "bad_payload"


@pytest.mark.parametrize("value", [80.5, "80", True, [], 3_000_000_000, 80.0])
def test_bad_whole_number(spark, value):
    assert outcome(spark, doc(main={"humidity": value})) == "bad_payload"
    assert outcome(spark, doc(visibility=value)) == "bad_payload"


@pytest.mark.parametrize("value", [0, None, False, "", [], {}, 0.0])
def test_falsy_epoch(spark, value):
    row = parse(spark, doc(sys={"sunrise": value}))[0]
    assert (row.outcome, row.sunrise, row.sunset) == ("ok", None, None)


@pytest.mark.parametrize("value", ["1700000000", [1], {"a": 1}, 1e15, "0"])
def test_bad_epoch(spark, value):
    assert outcome(spark, doc(sys={"sunset": value})) == "bad_payload"


def test_epoch(spark):
    rows = spark.createDataFrame([("JFK", 200, json.dumps(DOC))], "iata_code string, http_status int, payload string")
    row = O.parse_weather(rows).selectExpr("unix_timestamp(sunrise) AS up", "unix_timestamp(sunset) AS down").first()
    assert (row.up, row.down) == (1700000000, 1700040000)


@pytest.mark.parametrize(
    "status, expected",
    [(200, "ok"), (401, "auth"), (403, "auth"), (429, "rate_limited"), (404, "http_error"), (500, "http_error"), (None, "no_response")],
)
def test_outcome(spark, status, expected):
    assert parse(spark, DOC, status=status)[0].outcome == expected


def _airports(spark, rows):
    return spark.createDataFrame(
        rows,
        "iata_code string, icao_code string, name string, latitude_deg double, longitude_deg double, "
        "elevation_ft double, municipality string, iso_country string, scheduled_service boolean",
    )


def test_selection(spark):
    airports = _airports(
        spark,
        [
            ("A1", "", "b", 1.0, 2.0, 1.9, "", None, True),
            ("A2", None, None, 1.0, 2.0, -1.9, None, "", True),
            ("A3", "K3", "a", 0.0, 0.0, None, "m", "c", True),
            ("A4", "K4", "", 0.0, 5.0, float("nan"), "m", "c", True),
            ("", "K5", "a", 1.0, 2.0, None, "m", "c", True),
            (None, "K6", "a", 1.0, 2.0, None, "m", "c", True),
            ("A7", "K7", "a", None, 2.0, None, "m", "c", True),
            ("A8", "K8", "a", 1.0, None, None, "m", "c", True),
            ("A9", "K9", "a", 1.0, 2.0, None, "m", "c", False),
            ("B1", "K1", "a", 1.0, 2.0, None, "m", "c", None),
        ],
    )
    rows = {r.iata_code: r for r in A.select_airports(airports).collect()}
    assert set(rows) == {"A1", "A2"}
    assert rows["A1"][1:] == ("A1", "b", 1.0, 2.0, 1, "Unknown", "Unknown")
    assert rows["A2"][1:] == ("A2", "Unknown Airport", 1.0, 2.0, -1, "Unknown", "Unknown")


def test_null_island_counts_towards_the_limit(spark):
    airports = _airports(
        spark, [(f"A{i}", "K", name, lat, lat, None, "m", "c", True) for i, (name, lat) in enumerate([("a", 0.0), (None, 1.0), ("b", 1.0)])]
    )
    assert [r.iata_code for r in A.select_airports(airports, 2).collect()] == ["A1"]
    assert A.select_airports(airports, None).count() == 2


def test_tied_names_are_cut_by_code(spark):
    airports = _airports(spark, [(code, "K", "same", 1.0, 1.0, None, "m", "c", True) for code in ("C", "A", "B")])
    assert sorted(r.iata_code for r in A.select_airports(airports, 2).collect()) == ["A", "B"]


def test_fallback(spark, tmp_path):
    assert airports_or_static(spark, f"{tmp_path}/none").count() == 5
    assert static_airports(spark).schema == AIRPORT_INFO
    _airports(spark, []).write.parquet(f"{tmp_path}/empty")
    assert airports_or_static(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_join(spark, few):
    docs = spark.createDataFrame(
        [("JFK", 200, json.dumps(DOC)), ("LAX", 401, "{}"), ("LHR", 200, "{bad"), ("XXX", 200, json.dumps(DOC))],
        "iata_code string, http_status int, payload string",
    )
    table = P.weather_table(static_airports(spark), docs, utc_timestamp(RUN_AT), few_airports=few)
    assert len(table.columns) == 28
    row = table.collect()
    assert [(r.airport_iata_code, r.airport_icao_code, r.elevation_ft, str(r.extraction_date)) for r in row] == [
        ("JFK", "KJFK", None, "2024-01-02")
    ]
    tally = {r.outcome: r.fetches for r in P.weather_outcomes(static_airports(spark), docs, few_airports=few).collect()}
    assert tally == {"ok": 1, "auth": 1, "bad_payload": 1}


def test_tally_of_nothing(spark):
    empty = spark.createDataFrame([], "outcome string")
    assert fetch_outcomes(empty).count() == 0


def test_run_time_needs_a_zone():
    with pytest.raises(ValueError):
        utc_timestamp(dt.datetime(2024, 1, 1))
