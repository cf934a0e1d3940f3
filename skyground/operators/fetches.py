"""Outcomes of the landed fetches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def classify_fetch(http_status: Column, bad_payload: Column) -> Column:
    """``ok``, ``auth``, ``rate_limited``, ``http_error``, ``no_response`` or ``bad_payload``."""
    return (
        F.when(http_status.isNull(), "no_response")
        .when(http_status.isin(401, 403), "auth")
        .when(http_status == 429, "rate_limited")
        .when(http_status >= 400, "http_error")
        .when(bad_payload, "bad_payload")
        .otherwise("ok")
    )


def fetch_outcomes(parsed: DataFrame) -> DataFrame:
    """Number of fetches per outcome, from a frame with an ``outcome`` column."""
    return parsed.groupBy("outcome").agg(F.count(F.lit(1)).alias("fetches"))
