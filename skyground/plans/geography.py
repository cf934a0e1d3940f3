"""Landed country pages and place documents to the geography tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyground.operators import countries as C, places as P
from skyground.schemas import known_countries
from skyground.sources.pages import assemble_pages, void_listings
from skyground.sources.tables import append_by_day, replace_day, staged, written


def country_items(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Items of the country listing; feeds both the table and the choice of targets."""
    return assemble_pages(pages, page_size=10, limit=limit)


def countries_table(items: DataFrame, extraction_timestamp: Column) -> DataFrame:
    """The ``geography_countries`` relation of the listing's items."""
    return C.parse_countries(items, extraction_timestamp)


def targets(items: DataFrame) -> DataFrame:
    """The countries to take places from; ``items`` are those of one run's listing."""
    return C.target_countries(C.listed_codes(items), known_countries(items.sparkSession))


def judged_places(documents: DataFrame, wanted: DataFrame, extraction_timestamp: Column, limit: int | None = None) -> DataFrame:
    """Parsed cities of the wanted countries with their ``reject_reason``; one bad item rejects its whole country.

    With ``limit`` a country's first items count, over all its documents. Without, the parsed cities are written to the
    shared folder first, so that the bad countries and the cities are read from one parse.
    """
    wanted_documents = P.country_places(documents, wanted)
    if limit is not None:
        return P.parse_places(wanted_documents, extraction_timestamp, limit, "country")
    return P.veto_countries(written(P.mark_places(wanted_documents, extraction_timestamp), "places"))


def places_table(
    documents: DataFrame, wanted: DataFrame, extraction_timestamp: Column, limit: int | None = None
) -> DataFrame:
    """The ``geography_places`` relation of the wanted countries; see :func:`judged_places`."""
    return P.enrich_places(P.accepted_places(judged_places(documents, wanted, extraction_timestamp, limit)))


def run_geography(
    pages: DataFrame,
    documents: DataFrame,
    extraction_timestamp: Column,
    places: str,
    countries: str,
    *,
    rejects: str | None = None,
    per_country: int | None = None,
    replace: bool = False,
    fmt: str = "parquet",
) -> tuple[int, int]:
    """Append to both day tables, or replace their days on request; returns their numbers of rows.

    The listing is put together once for both. ``per_country`` cuts each country to its first items. Below ``rejects`` three day tables take what was left out, with reasons:
    ``places``, ``countries`` and ``listings``; place documents are parsed once for their two tables.
    """
    write = replace_day if replace else append_by_day
    items = country_items(pages).persist()
    try:
        documents = P.country_places(documents, targets(items))
        if per_country is None:
            parsed, judge = P.mark_places(documents, extraction_timestamp), P.veto_countries
        else:
            parsed, judge = P.parse_places(documents, extraction_timestamp, per_country, "country"), lambda rows: rows
        with staged(parsed, "places") as rows:
            judged = judge(rows)
            written_places = write(P.enrich_places(P.accepted_places(judged)), places, fmt=fmt)
            if rejects is not None:
                left_out = {
                    "places": P.rejected_places(judged),
                    "countries": C.rejected_countries(items, extraction_timestamp),
                    "listings": void_listings(pages).withColumn("extraction_timestamp", extraction_timestamp),
                }
                for name, rows_left_out in left_out.items():
                    day = F.to_date("extraction_timestamp")
                    write(rows_left_out.withColumn("extraction_date", day), f"{rejects}/{name}", fmt=fmt)
        return written_places, write(countries_table(items, extraction_timestamp), countries, fmt=fmt)
    finally:
        items.unpersist()
