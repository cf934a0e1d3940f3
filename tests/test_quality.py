from __future__ import annotations

import datetime as dt

import pytest

from skyground.operators import quality as Q

DAY = dt.date(2024, 1, 15)
OTHER = dt.date(2024, 1, 14)


def flights(spark, count):
    return spark.createDataFrame([(DAY,)] * count + [(OTHER,)] * 3, "extraction_date date")


def weather(spark, rows, airports):
    data = [(f"A{i % airports}", float(i), DAY) for i in range(rows)] + [("B", 1000.0, OTHER)]
    return spark.createDataFrame(data, "airport_iata_code string, temperature double, extraction_date date")


def places(spark, rows, countries):
    data = [(f"C{i % countries}", "CITY", DAY) for i in range(rows)] + [("X", "ADM2", OTHER)]
    return spark.createDataFrame(data, "country_code string, place_type string, extraction_date date")


def passed(gate):
    return {r.metric: r.passed for r in gate.collect()}


@pytest.mark.parametrize("count, expected", [(9, False), (10, True), (0, False)])
def test_flights(spark, count, expected):
    gate = Q.gate_flights(flights(spark, count), DAY)
    row = gate.first()
    assert (row.dataset, row.metric, row.value, row.threshold, row.passed) == ("flights", "record_count", count, 10.0, expected)


@pytest.mark.parametrize("rows, airports, expected", [(50, 20, (True, True)), (49, 20, (False, True)), (50, 19, (True, False))])
def test_weather(spark, rows, airports, expected):
    got = passed(Q.gate_weather(weather(spark, rows, airports), DAY))
    assert (got["record_count"], got["unique_airports"]) == expected
    assert got["avg_temperature"] is None


def test_weather_mean_skips_nulls_and_defaults_to_zero(spark):
    schema = "airport_iata_code string, temperature double, extraction_date date"

    def values(rows):
        return {r.metric: r.value for r in Q.gate_weather(spark.createDataFrame(rows, schema), DAY).collect()}

    assert values([("A", 1.0, DAY), ("A", 4.0, DAY), ("B", None, DAY), (None, 1.0, DAY)]) == {
        "record_count": 4.0, "unique_airports": 2.0, "avg_temperature": 2.0,
    }
    assert values([("A", None, DAY)])["avg_temperature"] == 0.0
    assert values([]) == {"record_count": 0.0, "unique_airports": 0.0, "avg_temperature": 0.0}


@pytest.mark.parametrize("rows, countries, expected", [(50, 10, (True, True)), (49, 10, (False, True)), (50, 9, (True, False))])
def test_places(spark, rows, countries, expected):
    gate = Q.gate_places(places(spark, rows, countries), DAY)
    got = passed(gate)
    assert (got["record_count"], got["unique_countries"]) == expected
    assert {r.metric: r.value for r in gate.collect()}["unique_place_types"] == 1.0


def test_all(spark):
    gates = [Q.gate_flights(flights(spark, 10), DAY), Q.gate_weather(weather(spark, 50, 20), DAY), Q.gate_places(places(spark, 49, 10), DAY)]
    rows = {r.dataset: (r.passed, r.checks) for r in Q.gate_all(*gates).collect()}
    assert rows == {"flights": (True, 1), "weather": (True, 2), "places": (False, 2), "all": (False, 5)}


def test_enforce(spark):
    Q.enforce(Q.gate_flights(flights(spark, 10), DAY))
    with pytest.raises(Q.QualityGateError, match="flights record_count is 9, at least 10 expected"):
        Q.enforce(Q.gate_flights(flights(spark, 9), DAY))
