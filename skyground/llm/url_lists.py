"""Filter captures by dated URL lists: entries become validity intervals, captures meet the active ones.

List events (``kind, pattern, action, verdict, at``) are folded to one event per entry and
instant, then to intervals ``[valid_from, valid_to)`` by the next event of the entry. A capture
gives one key for each form in which a list can name it (the host, each parent domain, each path
prefix), and joins on the key with the interval that holds its fetch time. The longest pattern
decides, ``allow`` before ``block`` on equal length.

Defined cases: a null or host-less url, or a null time, matches nothing; events with a null field
are ignored; of several events of an entry at one instant ``add`` wins; an entry added twice is
one interval; repeated captures each get their own row. An empty list matches nothing.
Columns of the captures are kept; result columns win over captures' columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyground.llm.common import boxed, others, staged, unboxed

RESULTS = ("host", "verdict", "kind", "pattern", "valid_from", "n_active")
FOREVER = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/:?#]+)", 2))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without query and fragment, ``/`` at least."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def intervals(events: DataFrame) -> DataFrame:
    """``kind, pattern, verdict, valid_from, valid_to`` of each stretch an entry is listed.

    Events are folded per entry and instant before the window, so an entry's window holds its
    instants, not its events.
    """
    entry = ["kind", "pattern", "verdict"]
    folded = (
        events.dropna(subset=[*entry, "action", "at"])
        .groupBy(*entry, "at")
        .agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    )
    order = Window.partitionBy(*entry).orderBy("at")
    # Only changes of state start or end an interval.
    changes = folded.withColumn("was", F.lag("on", 1, 0).over(order)).filter("on <> was")
    return (
        changes.withColumn("until", F.lead("at").over(order))
        .filter("on = 1")
        .select(
            *entry,
            F.col("at").alias("valid_from"),
            F.coalesce("until", F.lit(FOREVER).cast("timestamp")).alias("valid_to"),
        )
    )


def keys(url: Column) -> Column:
    """All (kind, pattern) under which a list can name ``url``."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.transform(
        F.when(F.size(segments) > 0, F.sequence(F.lit(1), F.size(segments))),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")),
    )
    return F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern"))),
        F.transform(parents, lambda p: F.struct(F.lit("domain").alias("kind"), p.alias("pattern"))),
        F.transform(
            F.coalesce(prefixes, F.array().cast("array<string>")),
            lambda p: F.struct(F.lit("prefix").alias("kind"), p.alias("pattern")),
        ),
    )


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """Every capture (``url``, ``fetched_at``) with :data:`RESULTS`; ``verdict`` is null where no entry was active."""
    carried = others(captures, RESULTS)
    rows = staged(
        captures.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col("url").alias("_url"),
            F.col("fetched_at").alias("_at"),
            boxed(carried),
        ),
        "captures",
    )
    asked = rows.filter(host_of(F.col("_url")).isNotNull() & F.col("_at").isNotNull()).select(
        "_row", "_at", F.explode(F.array_distinct(keys(F.col("_url")))).alias("_key")
    )
    asked = asked.select("_row", "_at", F.col("_key.kind").alias("kind"), F.col("_key.pattern").alias("pattern"))
    # Intervals of an entry do not overlap: a capture meets at most one of each verdict per key. The list
    # is written first, so that both sides are plain shuffles and a host with a third of the captures is split.
    active = asked.join(staged(intervals(events), "intervals").hint("merge"), ["kind", "pattern"]).filter(
        "valid_from <= _at and _at < valid_to"
    )
    best = active.groupBy("_row").agg(
        F.max(
            F.struct(
                F.length("pattern").alias("long"),
                (F.col("verdict") == "allow").alias("lenient"),
                "kind",
                "pattern",
                "verdict",
                "valid_from",
            )
        ).alias("_best"),
        F.count("*").alias("_n"),
    )
    return rows.join(best.hint("merge"), "_row", "left").select(
        *unboxed(carried),
        host_of(F.col("_url")).alias("host"),
        *[F.col(f"_best.{c}").alias(c) for c in ("verdict", "kind", "pattern", "valid_from")],
        F.coalesce("_n", F.lit(0)).alias("n_active"),
    )
