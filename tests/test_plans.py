"""The physical plans of the registered queries."""

from __future__ import annotations

import re

import pytest

from skyground.verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# These write while they are built; their plans only read back.
WRITERS = {"q23_day_partitions", "q24_replace_day", "q25_stream_ingest", "q28_daily_run", "q29_day_tables", "q38_empty_day", "q39_row_counts", "q41_daily_rejects", "q46_stream_sinks", "q48_incremental_view", "q50_run_ledger", "q51_audited_run", "q52_distinct_over_days"}


def plan(spark, key):
    return QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITERS))
def test_no_pair_joins_and_no_python(spark, key):
    text = plan(spark, key)
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


@pytest.mark.parametrize(
    "key",
    ["q01_parse_states", "q03_airborne", "q04_enrich_flights", "q07_parse_weather", "q15_location_key", "q27_reject_rows", "q33_flights_table"],
)
def test_row_work_does_not_shuffle(spark, key):
    assert not re.search(r"Exchange (hash|range|single|Round)", plan(spark, key))


@pytest.mark.parametrize("key", ["q02_state_rejects", "q09_fetch_outcomes", "q22_current_flights"])
def test_one_shuffle(spark, key):
    assert len(re.findall(r"Exchange hashpartitioning", plan(spark, key))) == 1


def test_selection_is_a_top_k_over_few_columns(spark):
    text = plan(spark, "q05_airports")
    assert "TakeOrderedAndProject" in text
    assert "c_nationkey" in text and "ReadSchema" in text


def test_gate_reads_what_it_counts(spark):
    schema = re.search(r"ReadSchema: (.*)", plan(spark, "q16_gate_flights")).group(1)
    assert schema.strip() == "struct<ts:timestamp_ntz>"


def test_airport_filters_reach_the_scan(spark, tmp_path):
    from skyground.operators.airports import select_airports
    from skyground.sources.airports import read_airports
    from skyground.verification.landing import airports

    airports(spark, SF_DIR).write.parquet(f"{tmp_path}/airports")
    text = select_airports(read_airports(spark, f"{tmp_path}/airports"))._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)
    for part in ("IsNotNull(latitude_deg)", "IsNotNull(longitude_deg)", "EqualTo(scheduled_service,true)", "IsNotNull(iata_code)", "Not(EqualTo(iata_code,))"):
        assert part in pushed.group(1)
    assert "c_custkey" not in pushed.group(2)


def test_enrichment_is_one_projection(spark, tmp_path):
    from skyground.operators.flights import enrich_flights
    from skyground.verification.landing import states

    states(spark, SF_DIR).write.parquet(f"{tmp_path}/states")
    text = enrich_flights(spark.read.parquet(f"{tmp_path}/states"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Project [") == 1


@pytest.mark.parametrize("key", ["q21_nearby_places", "q22_current_flights", "q30_current_weather"])
def test_groups_are_cut_before_the_shuffle(spark, key):
    text = plan(spark, key)
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_generated_code_stays_within_the_jit_limit(spark):
    """HotSpot does not compile methods above 8000 bytes of bytecode."""
    import contextlib
    import io

    for key in ("q01_parse_states", "q07_parse_weather", "q33_flights_table"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            QUERIES[key](spark, SF_DIR).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
        assert sizes and max(sizes) < 8000, (key, sizes)


def test_stored_documents_are_read_by_leaf(spark):
    text = plan(spark, "q54_variant_weather")
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    # Leaves by number in place of whole documents, and no text to parse.
    assert "doc" not in schema and "parsed:struct<0:" in schema and "payload" not in schema
    assert "parse_json" not in text


def test_both_forms_of_a_landing_parse_alike(spark, tmp_path):
    import json

    from pyspark.sql import functions as F

    from skyground.operators.flights import parse_states, with_raw
    from skyground.operators.weather import parse_weather
    from skyground.sources.landing import as_variant, unreadable_documents

    slots = ["a", " C ", "Spain", None, 5, 1.5, "2.5", None, 0, 1, None, None, None, None, "1", False, 0]
    payloads = [
        json.dumps({"states": [slots, slots[:3], [*slots[:4], "x", *slots[5:]], None, "s"]}), '{"states":null}', "{}", "[1]", "<html>", None,
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string").withColumn("extraction_timestamp", F.lit("2024-01-01").cast("timestamp"))
    as_variant(df).coalesce(1).write.parquet(f"{tmp_path}/states")
    stored = spark.read.parquet(f"{tmp_path}/states")
    seen = lambda rows: sorted(map(str, with_raw(parse_states(rows, keep_unreadable=True)).collect()))
    assert seen(stored) == seen(df) and len(seen(df)) == 8
    assert unreadable_documents(stored).count() == unreadable_documents(df).count()
    main = lambda **more: json.dumps({"main": {"temp": 1.5, "humidity": 80, **more}, "visibility": 9})
    # Whole numbers beside fractions and text: only those that are no whole numbers are rejected.
    payloads = [main(), main(humidity=80.5), main(temp="12.5", humidity=None), main(humidity="x"), "{}", '{"main":null}', '{"main":5}', "no", None]
    df = spark.createDataFrame([(i, 200, p) for i, p in enumerate(payloads)], "n int, http_status int, payload string")
    as_variant(df).coalesce(1).write.parquet(f"{tmp_path}/weather")
    stored = spark.read.parquet(f"{tmp_path}/weather")
    seen = lambda rows: sorted(map(str, parse_weather(rows).select("n", "outcome", "temperature", "humidity", "visibility").collect()))
    assert seen(stored) == seen(df)


@pytest.mark.parametrize("key", ["q28_daily_run", "q41_daily_rejects", "q46_stream_sinks", "q54_variant_weather"])
def test_written_tables_are_not_the_work_of_one_task(spark, monkeypatch, key):
    """The given tables are single files with one row group each; payloads are built and parsed on all cores all the same."""
    from skyground.verification import landing as L

    tasks = {}

    def counted(name):
        plain = getattr(L, name)
        monkeypatch.setattr(L, name, lambda *a, **k: tasks.setdefault(name, plain(*a, **k)))

    for name in ("states_landing", "weather_landing"):
        counted(name)
    QUERIES[key](spark, SF_DIR)
    assert tasks and all(df.rdd.getNumPartitions() >= 4 for df in tasks.values())
