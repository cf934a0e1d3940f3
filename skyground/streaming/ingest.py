"""Structured Streaming from a landing folder to the ``current_flights`` table and its rejects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skyground.operators.flights import accepted_states, enrich_flights, parse_states, rejected_states, with_raw
from skyground.schemas import CURRENT_FLIGHTS, FLIGHT_REJECTS, LANDING, conform
from skyground.sources.keys import KeyIndex, append_new
from skyground.sources.tables import staged

MAX_FILES = 1000


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = LANDING,
    fmt: str = "parquet",
    max_files: int | None = MAX_FILES,
) -> DataFrame:
    """New landing files as they arrive, at most ``max_files`` in a batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def flights_stream(landing: DataFrame) -> DataFrame:
    """Parsed and enriched flights; nothing is dropped for being late."""
    return conform(enrich_flights(accepted_states(parse_states(landing))), CURRENT_FLIGHTS)


def _hashed(*values: Column | str) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256))


def state_key() -> Column:
    """What makes two rows copies of one state: all that was parsed or derived, and the time of the snapshot only
    where no contact time or aircraft tells them apart."""
    same = [name for name in CURRENT_FLIGHTS.fieldNames() if name != "extraction_timestamp"]
    unknown = F.col("icao24").isNull() | F.col("last_contact").isNull()
    snapshot = F.when(unknown, F.col("extraction_timestamp").cast("string"))
    return _hashed(*same, snapshot.alias("snapshot"))


def reject_key() -> Column:
    """What makes two rejects copies: the same text rejected for the same reason in the same snapshot."""
    return _hashed(*FLIGHT_REJECTS.fieldNames())


def _once(flights: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        flights.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest(flights: DataFrame, table: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything that has arrived to the day table, then stop.

    The table is an ordinary one: batch runs may append to it as well. The checkpoint holds the
    offsets, so a restart, after a failure or the next day, goes on where the last run ended. A batch that runs
    again finds its rows in the table, so nothing is written twice; rows are never lost, however late they are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, KeyIndex(batch.sparkSession, table, CURRENT_FLIGHTS, state_key, fmt))

    return _once(flights, write, checkpoint)


def ingest_landing(
    landing: DataFrame, table: str, rejects: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Parse everything that has arrived and append accepted states to one day table, rejected ones to another, then stop.

    A batch is parsed once, staged, and both tables written from there. Each holds a row once: should a batch fail
    between them and run again, the first finds its rows there and the second gets what it lacks. Payloads that are no JSON
    object are rejects as well (``unreadable``). Rejects are kept by day with reason and text.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        judged = with_raw(parse_states(batch, keep_unreadable=True))
        judged = judged.withColumn("_accepted", F.col("reject_reason").isNull())
        with staged(judged, "stream", "_accepted") as rows:
            accepted = accepted_states(rows.filter("_accepted").drop("_accepted"))
            flights = conform(enrich_flights(accepted), CURRENT_FLIGHTS)
            append_new(flights, KeyIndex(spark, table, CURRENT_FLIGHTS, state_key, fmt))
            rejected = rejected_states(rows.filter("not _accepted").drop("_accepted"))
            dated = rejected.withColumn("extraction_date", F.to_date("extraction_timestamp"))
            append_new(conform(dated, FLIGHT_REJECTS), KeyIndex(spark, rejects, FLIGHT_REJECTS, reject_key, fmt))

    return _once(landing, write, checkpoint)
