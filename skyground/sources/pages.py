"""Paged listings, landed one row per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyground.functions import variant as V


def _answers(pages: DataFrame, listing: str, max_offset: int | None) -> DataFrame:
    """One row per listing and offset: its latest good answer, or any other where no good one landed.

    ``status`` is ``ok``, ``failed`` (another status than 200 and 429), ``unanswered`` (only 429 or none)
    or ``not_json`` (no JSON object). ``fetched_at`` orders answers where the pages have it.
    """
    if "http_status" not in pages.columns:
        pages = pages.withColumn("http_status", F.lit(200))
    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    if max_offset is not None:
        pages = pages.filter(F.col("page_offset") < max_offset)
    code = F.coalesce("http_status", F.lit(429))
    document = V.document("payload")
    status = (
        F.when(code == 429, "unanswered")
        .when(code != 200, "failed")
        .when(F.coalesce(V.is_object(document), F.lit(False)), "ok")
        .otherwise("not_json")
    )
    judged = pages.withColumn("status", status)
    # A refusal counts only where nothing else ever came.
    order = F.struct(
        (F.col("status") == "ok").alias("good"), (F.col("status") != "unanswered").alias("came"), "fetched_at", "payload"
    )
    others = [c for c in pages.columns if c not in (listing, "page_offset", "payload", "http_status", "fetched_at")]
    answer = F.struct("payload", "status", *others)
    best = judged.groupBy(listing, "page_offset").agg(F.max_by(answer, order).alias("answer"))
    return best.select(listing, "page_offset", "answer.*")


def _with_sizes(answers: DataFrame) -> DataFrame:
    items = V.items(V.document("payload"), "$.data")
    return answers.withColumn("items", F.when(F.col("status") == "ok", items)).withColumn(
        "size", F.coalesce(F.size("items"), F.lit(0))
    )


def _bound(max_offset: int | None, limit: int | None) -> int | None:
    """The offset from which on no page is asked for."""
    return min([x for x in (max_offset, limit) if x is not None], default=None)


def _listings(answers: DataFrame, page_size: int, listing: str, bound: int | None) -> DataFrame:
    """Where each listing stops, and why it is void if it is; page headers are all this reads.

    All pages before the stop are full, so their number says whether one is missing. A listing that never showed a short
    page goes on: it is ``open`` unless its next page would begin at the ``bound``.
    """
    heads = answers.select(listing, "page_offset", "status", "size")
    short = (F.col("status") == "ok") & (F.col("size") < page_size)
    stops = heads.groupBy(listing).agg(F.min(F.when(short, F.col("page_offset"))).alias("stop"))
    before = F.col("stop").isNull() | (F.col("page_offset") < F.col("stop"))
    ends = heads.join(stops, listing).groupBy(listing, "stop").agg(
        F.min(F.when(before & (F.col("status") != "ok"), F.struct("page_offset", "status"))).alias("bad"),
        F.count_if(before & (F.col("status") == "ok")).alias("full"),
        F.max("page_offset").alias("last"),
    )
    expected = F.coalesce(F.col("stop"), F.col("last") + page_size)
    goes_on = F.col("stop").isNull()
    if bound is not None:
        goes_on &= F.col("last") + page_size < bound
    reason = F.coalesce(
        F.col("bad.status"), F.when(F.col("full") * page_size != expected, "gap"), F.when(goes_on, "open")
    )
    return ends.select(listing, "stop", "last", reason.alias("void_reason"))


def assemble_pages(
    pages: DataFrame,
    *,
    page_size: int = 10,
    max_offset: int | None = None,
    limit: int | None = None,
    listing: str = "listing",
) -> DataFrame:
    """Items of each whole listing in order, as (listing columns, page_offset, pos, item).

    A listing ends with its first page of fewer than ``page_size`` items, which still counts unless it is
    empty. Each offset is read once, by its latest good answer. A page before the end that failed, that was never
    answered, that is no JSON object, or that never landed makes its listing void, and so does an end that never came: none of its
    items come out, :func:`void_listings` names it and :func:`missing_pages` what to ask for. ``max_offset`` and ``limit`` cut every listing, by default nothing does.

    No window holds the items of a listing: all pages before its end are full, so an item's
    place is its page's offset and its place there.
    """
    # A page that begins at the limit or beyond would not be asked for.
    bound = _bound(max_offset, limit)
    answers = _with_sizes(_answers(pages, listing, bound))
    ends = _listings(answers, page_size, listing, bound).filter(F.col("void_reason").isNull())
    reached = answers.join(ends.select(listing, "stop"), listing).filter(
        F.col("stop").isNull() | (F.col("page_offset") <= F.col("stop"))
    )
    items = reached.drop("payload", "status", "size", "stop").select("*", F.posexplode("items").alias("pos", "item"))
    items = items.drop("items")
    return items if limit is None else items.filter(F.col("page_offset") + F.col("pos") < limit)


def void_listings(
    pages: DataFrame,
    *,
    page_size: int = 10,
    max_offset: int | None = None,
    limit: int | None = None,
    listing: str = "listing",
) -> DataFrame:
    """Listings that are not whole, with ``void_reason``: ``failed``, ``unanswered``, ``not_json``, ``gap`` or ``open``."""
    bound = _bound(max_offset, limit)
    answers = _with_sizes(_answers(pages, listing, bound))
    ends = _listings(answers, page_size, listing, bound)
    return ends.filter(F.col("void_reason").isNotNull()).select(listing, "void_reason")


def missing_pages(
    pages: DataFrame,
    *,
    page_size: int = 10,
    max_offset: int | None = None,
    limit: int | None = None,
    listing: str = "listing",
    wanted: DataFrame | None = None,
) -> DataFrame:
    """The pages to ask for so that every listing becomes whole: (listing, page_offset, reason).

    What a listing should have is the sequence of offsets up to its end, or, while no short page was seen, up to its
    last landed page and, if that was answered, the one behind it (``open``). Offsets without a good answer come out with what
    landed for them (``failed``, ``unanswered``, ``not_json``) or ``gap`` for nothing. Of ``wanted`` listings
    nothing of which landed, the first page is ``open``. Whole listings give no rows; asking, landing and calling
    again ends when there are none.

    Only page headers are compared, by (listing, offset), so a listing with many pages spreads.
    """
    bound = _bound(max_offset, limit)
    answers = _with_sizes(_answers(pages, listing, bound)).select(listing, "page_offset", "status", "size")
    landed = answers.select(listing, "page_offset", "status")
    ends = _listings(answers, page_size, listing, bound)
    last = landed.select(listing, F.col("page_offset").alias("last"), (F.col("status") == "ok").alias("answered"))
    ends = ends.join(last, [listing, "last"])
    behind = F.col("last") + F.when(F.col("answered"), page_size).otherwise(0)
    until = F.coalesce(F.col("stop"), behind if bound is None else F.least(behind, F.lit(bound - 1)))
    offsets = ends.select(
        listing,
        (F.col("stop").isNull() & F.col("answered")).alias("goes_on"),
        "last",
        F.explode(F.sequence(F.lit(0), until.cast("int"), F.lit(page_size))).alias("page_offset"),
    )
    asked = offsets.join(landed, [listing, "page_offset"], "left")
    nothing = F.when(F.col("goes_on") & (F.col("page_offset") > F.col("last")), "open").otherwise("gap")
    missing = asked.filter(F.col("status").isNull() | (F.col("status") != "ok")).select(
        listing, "page_offset", F.coalesce("status", nothing).alias("reason")
    )
    if wanted is None:
        return missing
    unasked = wanted.select(listing).distinct().join(landed.select(listing).distinct(), listing, "left_anti")
    return missing.unionByName(unasked.select(listing, F.lit(0).alias("page_offset"), F.lit("open").alias("reason")))
