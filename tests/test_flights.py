from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skyground.operators import flights as O
from skyground.plans.flights import flights_table, run_flights
from skyground.sources.landing import explode_states, unreadable_documents

GOOD = ["abc123", "CALL1   ", "Spain", 1700000000, 1700000001, 1.5, 2.5, 100.0, False, 50.5, 90, -1.5, None, 110.0, "1234", False, 0]


def state(**slots):
    row = list(GOOD)
    for name, value in slots.items():
        row[[n for _, n, _ in O.STATE_SLOTS].index(name)] = value
    return row


def landing(spark, *payloads):
    rows = [(p if isinstance(p, str) else json.dumps(p),) for p in payloads]
    return spark.createDataFrame(rows, "payload string").withColumn(
        "extraction_timestamp", F.lit("2024-01-02 03:30:00").cast("timestamp")
    )


def parsed(spark, *states):
    return O.parse_states(landing(spark, {"time": 1, "states": list(states)})).collect()


def only(spark, **slots):
    return parsed(spark, state(**slots))[0]


@pytest.mark.parametrize("payload", ['{"states":null}', '{"states":[]}', "{}", "{bad", "[]", "null", '{"states":7}'])
def test_no_states_no_rows(spark, payload):
    assert explode_states(landing(spark, payload)).count() == 0


def test_one_document_holds_many_states(spark):
    rows = parsed(spark, GOOD, state(icao24="def456"), None, GOOD[:16])
    assert [r.reject_reason for r in rows] == [None, None, "arity", "arity"]
    assert [r.icao24 for r in rows[:2]] == ["abc123", "def456"]


def test_more_slots_are_ignored(spark):
    assert parsed(spark, [*GOOD, "extra"])[0].reject_reason is None


@pytest.mark.parametrize("value", ["text", 5, {"a": 1}])
def test_state_that_is_no_array(spark, value):
    assert [r.reject_reason for r in parsed(spark, value)] == ["arity"]


def test_values(spark):
    row = parsed(spark, GOOD)[0]
    assert [row[name] for _, name, _ in O.STATE_SLOTS] == ["abc123", "CALL1", *GOOD[2:]]


@pytest.mark.parametrize(
    "value, expected",
    [(" AB ", "AB"), ("        ", ""), ("\t A B\n", "A B"), (None, None), (5, "5"), (True, "true"), ([1, 2], "[1,2]")],
)
def test_text(spark, value, expected):
    row = only(spark, callsign=value)
    assert (row.callsign, row.reject_reason) == (expected, None)


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, None),
        (7, 7.0),
        (1.25, 1.25),
        (1e300, 1e300),
        ("12.5", 12.5),
        (" -.5e1 ", -5.0),
        ("inf", float("inf")),
        ("-Infinity", float("-inf")),
        (True, 1.0),
    ],
)
def test_number(spark, value, expected):
    row = only(spark, velocity=value)
    assert (row.velocity, row.reject_reason) == (expected, None)


def test_nan_position_is_kept(spark):
    row = only(spark, longitude="nan")
    assert row.longitude != row.longitude and row.reject_reason is None


@pytest.mark.parametrize("value", ["n/a", "", "1.5d", "2f", "0x1p3", "true", [], [1], {}, {"a": 1}, "1,5"])
@pytest.mark.parametrize("name", ["velocity", "latitude"])
def test_bad_number(spark, name, value):
    assert only(spark, **{name: value}).reject_reason == "bad_cast"


@pytest.mark.parametrize(
    "value, expected", [(None, None), (12, 12), (1.9, 1), (-1.9, -1), (1e5, 100000), ("12", 12), (" 12 ", 12), (True, 1)]
)
def test_integer(spark, value, expected):
    row = only(spark, time_position=value)
    assert (row.time_position, row.reject_reason) == (expected, None)


@pytest.mark.parametrize("value", ["1.5", "abc", "12d", 3_000_000_000, 1e300, [], {}])
def test_bad_integer(spark, value):
    assert only(spark, position_source=value).reject_reason == "bad_cast"


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, None), (True, True), (False, False), (0, False), (0.0, False), (2, True), ("", False), ("false", True),
        ("0", True), ([], False), ({}, False), ([0], True), ("[]", True),
    ],
)
def test_truth(spark, value, expected):
    assert only(spark, on_ground=value).on_ground is expected
    assert only(spark, spi=value).spi is expected


def test_reason_order(spark):
    rows = parsed(
        spark,
        state(velocity="n/a", longitude=None)[:16],
        state(velocity="n/a", longitude=None),
        state(longitude=None),
        state(latitude=None),
    )
    assert [r.reject_reason for r in rows] == ["arity", "bad_cast", "no_position", "no_position"]


def test_rejects_complement_accepted(spark):
    df = O.parse_states(landing(spark, {"states": [GOOD, state(velocity="n/a"), None]}))
    assert O.accepted_states(df).count() == 1
    rows = O.rejected_states(df).collect()
    assert sorted(r.reject_reason for r in rows) == ["arity", "bad_cast"]
    assert any(r.raw and '"n/a"' in r.raw for r in rows)


def test_airborne_needs_a_known_flag(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "on_ground boolean")
    assert O.airborne_flights(df).count() == 1


def test_enrichment(spark):
    rows = O.enrich_flights(
        O.accepted_states(
            O.parse_states(
                landing(spark, {"states": [GOOD, state(baro_altitude=None, velocity=None, vertical_rate=None, on_ground=None), state(on_ground=True)]})
            )
        )
    ).collect()
    first = rows[0]
    assert (first.altitude_ft, first.velocity_knots, first.vertical_rate_fpm) == (100 * 3.28084, 50.5 * 1.94384, -1.5 * 196.85)
    assert [r.flight_status for r in rows] == ["Airborne", "Unknown", "On Ground"]
    assert [r.has_altitude for r in rows] == [True, False, True]
    assert rows[1].altitude_ft is None and rows[1].velocity_knots is None and rows[1].vertical_rate_fpm is None
    # 03:30 UTC is the evening before in the time zone the test JVM runs in.
    assert {str(r.extraction_date) for r in rows} == {"2024-01-02"}


def test_run_counts_and_keeps_rejects(spark, tmp_path):
    docs = landing(spark, {"states": [GOOD, GOOD, state(velocity="n/a"), None, state(longitude=None)]})
    for _ in range(2):
        run = run_flights(docs, f"{tmp_path}/table", rejects=f"{tmp_path}/rejects", replace=True)
        assert run.written == 2
        assert run.rejected == {"unreadable": 0, "arity": 1, "bad_cast": 1, "no_position": 1}
    assert spark.read.parquet(f"{tmp_path}/table").count() == 2
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 3
    run_flights(docs, f"{tmp_path}/table", replace=False)
    assert spark.read.parquet(f"{tmp_path}/table").count() == 4


def test_unreadable_snapshots_are_rejects(spark, tmp_path, monkeypatch):
    from skyground.sources import tables

    folders = []
    monkeypatch.setattr(tables, "shared_folder", lambda spark, name: folders.append(f"{tmp_path}/stage") or folders[-1])
    docs = landing(spark, {"states": [GOOD, None]}, {"states": None}, "<html>", "[]", None)
    for rejects in (None, f"{tmp_path}/rejects"):
        run = run_flights(docs, f"{tmp_path}/table", rejects=rejects)
        assert run.written == 1
        assert run.rejected == {"unreadable": 3, "arity": 1, "bad_cast": 0, "no_position": 0}
    rows = spark.read.parquet(f"{tmp_path}/rejects").select("reject_reason", "raw").collect()
    assert sorted((r.reject_reason, r.raw or "") for r in rows if r.reject_reason == "unreadable") == [
        ("unreadable", "<html>"),
        ("unreadable", "[]"),
        ("unreadable", "null"),
    ]
    assert len(rows) == 4
    # What was staged is gone.
    assert len(folders) == 1 and not (tmp_path / "stage").exists()


def test_table_columns(spark):
    assert len(flights_table(landing(spark, "{}")).columns) == 25


def test_unreadable_documents(spark):
    docs = landing(spark, "{}", {"states": None}, "<html>", "[]", "null", "")
    assert sorted(r.payload for r in unreadable_documents(docs).collect()) == ["", "<html>", "[]", "null"]
