"""Run times as column literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def utc_timestamp(moment: dt.datetime) -> Column:
    """A timestamp literal; ``moment`` must carry a time zone, so no local zone creeps in."""
    if moment.tzinfo is None:
        raise ValueError("the run time needs a time zone")
    return F.timestamp_micros(F.lit((moment - _EPOCH) // dt.timedelta(microseconds=1)))
