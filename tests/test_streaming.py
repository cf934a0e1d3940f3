from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from skyground.plans.flights import flights_table
from skyground.schemas import CURRENT_FLIGHTS
from skyground.sources.tables import append_by_day, replace_day
from skyground.sources.keys import KeyIndex, append_new
from skyground.streaming import ingest as S
from skyground.streaming.ingest import flights_stream, ingest, ingest_landing, landing_stream, state_key


def state(icao24, contact, on_ground=False, longitude=1.0):
    return [icao24, "C", "Spain", None, contact, longitude, 2.0, None, on_ground, None, None, None, None, None, None, False, 0]


def land(spark, path, at, *states):
    rows = [(json.dumps({"states": list(states)}),)]
    spark.createDataFrame(rows, "payload string").withColumn(
        "extraction_timestamp", F.lit(at).cast("timestamp")
    ).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path):
    stream = flights_stream(landing_stream(spark, f"{tmp_path}/landing", max_files=1))
    ingest(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{tmp_path}/table")


def test_two_drops_equal_the_batch(spark, tmp_path):
    path = f"{tmp_path}/landing"
    land(spark, path, "2024-01-01 10:00:00", state("a", 1), state("b", 1), state("x", 1, longitude=None))
    assert run(spark, tmp_path).count() == 2
    # The same snapshot again, and a newer one.
    land(spark, path, "2024-01-01 10:00:00", state("a", 1), state("b", 1))
    land(spark, path, "2024-01-02 10:00:00", state("a", 2), state("a", 2), state("c", None))
    table = run(spark, tmp_path)
    batch = flights_table(spark.read.parquet(path)).dropDuplicates(["icao24", "last_contact"])
    key = ["icao24", "last_contact", "extraction_date", "flight_status"]
    assert sorted(map(str, table.select(key).collect())) == sorted(map(str, batch.select(key).collect()))
    assert table.count() == 4
    assert set(table.columns) == set(CURRENT_FLIGHTS.fieldNames())
    # Nothing new: nothing happens.
    assert run(spark, tmp_path).count() == 4


def test_unknown_contacts_and_late_files_stay(spark, tmp_path):
    path = f"{tmp_path}/landing"
    land(spark, path, "2024-01-20 00:00:00", state("a", None), state(None, 3))
    land(spark, path, "2024-01-20 12:00:00", state("a", None), state(None, 3))
    assert run(spark, tmp_path).count() == 4
    # Eleven days older than what is there.
    land(spark, path, "2024-01-09 00:00:00", state("z", 1))
    assert run(spark, tmp_path).count() == 5
    # States that differ in anything are no copies.
    land(spark, path, "2024-01-20 12:00:00", state("z", 1), state("z", 1, longitude=9.0))
    assert run(spark, tmp_path).count() == 7


def test_batch_and_stream_share_a_table(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", "2024-01-01 10:00:00", state("a", 1))
    assert run(spark, tmp_path).count() == 1
    land(spark, f"{tmp_path}/other", "2024-01-01 11:00:00", state("b", 1))
    assert append_by_day(flights_table(spark.read.parquet(f"{tmp_path}/other")), f"{tmp_path}/table") == 1
    assert spark.read.parquet(f"{tmp_path}/table").count() == 2
    # What a batch wrote is not written again by the stream.
    land(spark, f"{tmp_path}/landing", "2024-01-01 11:00:00", state("b", 1), state("c", 1))
    assert run(spark, tmp_path).count() == 3


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", "2024-01-01 10:00:00", state("a", 1), state("b", None))
    assert run(spark, tmp_path).count() == 2
    stream = flights_stream(landing_stream(spark, f"{tmp_path}/landing"))
    ingest(stream, f"{tmp_path}/table", f"{tmp_path}/another").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/table").count() == 2


def run_both(spark, tmp_path, checkpoint="checkpoint"):
    stream = landing_stream(spark, f"{tmp_path}/landing", max_files=1)
    ingest_landing(stream, f"{tmp_path}/table", f"{tmp_path}/rejects", f"{tmp_path}/{checkpoint}").awaitTermination()
    rejects = spark.read.parquet(f"{tmp_path}/rejects").collect()
    return spark.read.parquet(f"{tmp_path}/table").count(), sorted(r.reject_reason for r in rejects)


def test_rejects_have_a_table_of_their_own(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/landing"
    land(spark, path, "2024-01-01 10:00:00", state("a", 1), state("x", 1, longitude=None), ["short"], state("y", "n/a"))
    page = spark.createDataFrame([("<html>",)], "payload string").withColumn("extraction_timestamp", F.lit("2024-01-01 11:00:00").cast("timestamp"))
    page.write.mode("append").parquet(path)
    want = (1, ["arity", "bad_cast", "no_position", "unreadable"])
    assert run_both(spark, tmp_path) == want
    # The same files again under another checkpoint: every batch runs again and adds nothing.
    assert run_both(spark, tmp_path, "another") == want
    raw = {r.reject_reason: r.raw for r in spark.read.parquet(f"{tmp_path}/rejects").collect()}
    assert raw["unreadable"] == "<html>" and json.loads(raw["arity"]) == ["short"]
    # A batch that fails between its tables runs again: nothing is doubled, nothing lost.
    land(spark, path, "2024-01-02 10:00:00", state("b", 1), ["short"])
    real, calls = S.append_new, []

    def failing(rows, index):
        calls.append(index.table)
        if index.table.endswith("rejects"):
            raise RuntimeError("lost")
        return real(rows, index)

    monkeypatch.setattr(S, "append_new", failing)
    try:
        run_both(spark, tmp_path)
    except Exception:  # the stream's own error type wraps it
        pass
    monkeypatch.setattr(S, "append_new", real)
    assert len(calls) == 2
    assert run_both(spark, tmp_path) == (2, ["arity", *want[1]])


def test_rows_are_hashed_once(spark, tmp_path):
    path, table = f"{tmp_path}/landing", f"{tmp_path}/table"
    land(spark, path, "2024-01-01 10:00:00", state("a", 1), state("b", 1))
    land(spark, f"{tmp_path}/other", "2024-01-01 11:00:00", state("c", 1))
    land(spark, f"{tmp_path}/new", "2024-01-01 12:00:00", state("a", 1), state("d", 1))
    flights = lambda p: flights_table(spark.read.parquet(p))
    index = KeyIndex(spark, table, CURRENT_FLIGHTS, state_key)
    every = F.lit(True)
    assert index.keys(every) is None and index.sync(every) == 0
    assert append_new(flights(path), index) == 2
    # A file of its own and one a batch run wrote are indexed, each once.
    append_by_day(flights(f"{tmp_path}/other"), table)
    files = index.sync(every)
    assert files >= 2 and index.sync(every) == 0 and index.keys(every).count() == 3
    assert append_new(flights(f"{tmp_path}/new"), index) == 1
    assert index.keys(every).count() == 4
    # The day is replaced by as many other rows: what the old files held does not count any more.
    land(spark, f"{tmp_path}/instead", "2024-01-01 09:00:00", *[state(name, 7) for name in "abcd"])
    replace_day(flights(f"{tmp_path}/instead"), table)
    assert append_new(flights(path), index) == 2 and append_new(flights(f"{tmp_path}/instead"), index) == 0


def test_keys_are_read_and_not_the_rows(spark, tmp_path):
    table = f"{tmp_path}/table"
    land(spark, f"{tmp_path}/landing", "2024-01-01 10:00:00", state("a", 1))
    index = KeyIndex(spark, table, CURRENT_FLIGHTS, state_key)
    append_new(flights_table(spark.read.parquet(f"{tmp_path}/landing")), index)
    plan = index.keys(F.col("extraction_date") == "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    # Of the table's files only names; of the index the day's keys.
    assert set(re.findall(r"ReadSchema: (\S+)", plan)) == {"struct<>", "struct<file:string,key:binary>"}
    assert plan.count("PartitionFilters: [isnotnull(extraction_date") >= 2


def test_rows_without_a_time_are_kept_once(spark, tmp_path):
    path = f"{tmp_path}/landing"
    rows = [(json.dumps({"states": [state("a", 1)]}), None)]
    spark.createDataFrame(rows, "payload string, extraction_timestamp timestamp").coalesce(1).write.parquet(path)
    assert run(spark, tmp_path).count() == 1
    stream = flights_stream(landing_stream(spark, path))
    ingest(stream, f"{tmp_path}/table", f"{tmp_path}/another").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/table").count() == 1
