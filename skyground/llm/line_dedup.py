"""Cross-site boilerplate removal by the distinct-site spread of lines.

Lines are hashed; lines seen on one site only are dropped by a plain min/max aggregation.
For the rest, HyperLogLog sketches of the site are built per line hash (partial sketches merge in
the aggregation). A sketch far from the threshold decides; near it, within ``band`` standard
errors, the sites are counted exactly. Lines on at least ``min_sites`` sites are removed wherever
they stand.

Defined cases: null text is the empty text; a line is trimmed of blanks before hashing, and
lines that are then empty (or shorter than ``min_chars``, if one asks for more) always stay; null site counts as one site of its
own; repeated rows are treated alike; an empty table gives no rows. Columns of the documents are
kept unless a result column has their name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyground.functions.variant import with_computed
from skyground.llm.common import boxed, others, staged, unboxed

MIN_SITES = 6
MIN_CHARS = 1
LOG_K = 8
BAND = 4.0
RESULTS = ("n_lines", "n_removed", "kept_text")


def sketch_error(log_k: int) -> float:
    """Relative standard error of a sketch with 2**log_k registers, as its library states it."""
    return 1.04 / (2 ** (log_k / 2))


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """``_row, _at, _hash, _site`` of each line that is long enough; two hashes of 64 bits name a line."""
    lines = rows.select(
        "_row",
        F.xxhash64(F.coalesce("site", F.lit("")), F.col("site").isNull()).alias("_site"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("_at", "_line"),
    ).withColumn("_line", F.trim("_line"))
    return lines.filter(F.length("_line") >= min_chars).select(
        "_row", "_at", F.xxhash64("_line").alias("_h1"), F.hash("_line").alias("_h2"), "_site"
    )


def boilerplate(lines: DataFrame, min_sites: int, log_k: int = LOG_K, band: float = BAND) -> DataFrame:
    """``_h1, _h2`` of the lines on at least ``min_sites`` sites."""
    line = ["_h1", "_h2"]
    # Most lines stand on one site; they are gone before any sketch is made.
    spread = (
        lines.groupBy(*line)
        .agg(F.min("_site").alias("lo"), F.max("_site").alias("hi"))
        .filter("lo <> hi" if min_sites > 1 else "true")
        .select(*line)
    )
    several = staged(lines.join(staged(spread, "spread"), line, "left_semi").select(*line, "_site"), "several")
    margin = band * sketch_error(log_k)
    guessed = staged(
        several.groupBy(*line)
        .agg(F.hll_sketch_agg("_site", log_k).alias("sketch"))
        .select(*line, F.hll_sketch_estimate("sketch").alias("sites")),
        "guessed",
    )
    sure = guessed.filter(F.col("sites") > min_sites * (1 + margin)).select(*line)
    near = guessed.filter(F.col("sites").between(min_sites * (1 - margin), min_sites * (1 + margin))).select(*line)
    exact = (
        several.join(near, line, "left_semi")
        .distinct()
        .groupBy(*line)
        .count()
        .filter(F.col("count") >= min_sites)
        .select(*line)
    )
    return sure.union(exact)


def remove_boilerplate(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    log_k: int = LOG_K,
    band: float = BAND,
) -> DataFrame:
    """Every document with its line counts and ``kept_text``."""
    carried = others(docs, RESULTS)
    numbered = docs.select(
        # Two hashes of 64 bits name a row, as they do a line.
        F.struct(F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "doc_id", "text")).alias("_row"), F.col(site).alias("site"), "text", boxed(carried)
    )
    lines = staged(_lines(numbered.select("_row", "site", "text"), min_chars), "lines")
    drop = staged(boilerplate(lines, min_sites, log_k, band), "boilerplate")
    # A document's removed lines fit beside its text. Repeated rows share _row and get the same list.
    removed = (
        lines.join(drop, ["_h1", "_h2"], "left_semi")
        .select("_row", "_at")
        .distinct()
        .groupBy("_row")
        .agg(F.collect_list("_at").alias("_removed"))
    )
    # Always by shuffle: the list of removals grows with the documents.
    joined = numbered.join(staged(removed, "removed").hint("merge"), "_row", "left")
    split = with_computed(joined, "_parts", F.split(F.coalesce("text", F.lit("")), "\n"))
    parts = F.col("_parts")
    # Both steps take time linear in the lines: a set of removed places, then one look per place that stays.
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_removed"))
    kept = F.when(F.col("_removed").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    )
    return split.select(
        *unboxed(carried),
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )
