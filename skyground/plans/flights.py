"""Landed snapshots to ``current_flights``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, functions as F

from skyground.operators import flights as O
from skyground.schemas import CURRENT_FLIGHTS, conform
from skyground.sources.tables import append_by_day, replace_day, staged

REASONS = ["unreadable", "arity", "bad_cast", "no_position"]


class FlightsRun(NamedTuple):
    written: int
    rejected: dict[str, int]


def flights_table(landing: DataFrame) -> DataFrame:
    """The ``current_flights`` relation of landed snapshots."""
    return conform(O.enrich_flights(O.accepted_states(O.parse_states(landing))), CURRENT_FLIGHTS)


def run_flights(
    landing: DataFrame,
    table: str,
    *,
    rejects: str | None = None,
    replace: bool = False,
    compact: bool = False,
    fmt: str = "parquet",
) -> FlightsRun:
    """Append to the day table, or replace its days on request, and write the rejected states to ``rejects`` if there are any.

    A payload that is no JSON object counts as one rejected row with the reason ``unreadable``. The landing is read and
    parsed once: rejects are counted on the way, and where they are kept the parsed
    rows are staged, accepted and rejected apart, and both tables written from there.
    With ``compact`` and no ``rejects`` the counts are taken before a shuffle, and rows of a task that
    had to run again count twice in them; the tables themselves do not change.
    """
    write = replace_day if replace else append_by_day
    seen = Observation()
    parsed = O.parse_states(landing, keep_unreadable=True).observe(
        seen, *[F.count_if(F.col("reject_reason") == reason).alias(reason) for reason in REASONS]
    )
    if rejects is None:
        written = write(conform(O.enrich_flights(O.accepted_states(parsed)), CURRENT_FLIGHTS), table, compact=compact, fmt=fmt)
        return FlightsRun(written, {reason: seen.get[reason] for reason in REASONS})
    judged = O.with_raw(parsed).withColumn("_accepted", F.col("reject_reason").isNull())
    with staged(judged, "flights", "_accepted") as rows:
        accepted = O.accepted_states(rows.filter("_accepted").drop("_accepted"))
        written = write(conform(O.enrich_flights(accepted), CURRENT_FLIGHTS), table, compact=compact, fmt=fmt)
        rejected = {reason: seen.get[reason] for reason in REASONS}
        if any(rejected.values()):
            dropped = O.rejected_states(rows.filter("not _accepted").drop("_accepted"))
            write(dropped.withColumn("extraction_date", F.to_date("extraction_timestamp")), rejects, compact=compact, fmt=fmt)
    return FlightsRun(written, rejected)
