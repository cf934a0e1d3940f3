"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is digested once, its own copies
are counted by a pre-aggregating group-by, and one row per digest meets the index in a
sort-merge anti-join to which the index side brings no shuffle. Digests that the index lacks are
appended, with the row that stays and the batch that brought it. What becomes of every row is then read from the
index, by a second sort-merge join. Running a batch again appends nothing.

Defined cases: null text is the empty text; of equal texts the row with the largest ``doc_id``
stays (null smallest), of rows that tie on it exactly one; a text the index already holds
keeps no row of the batch; an empty batch gives no rows. Columns of the batch beyond
``doc_id`` and ``text`` are carried along unless a result column has their name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyground.llm.common import ascii_lower, boxed, others, scratch, shuffle_partitions, staged, unboxed

RESULTS = ("keep_id", "group_size", "kept", "text_sha256")
# A first load meets the index in so many ranges of doc_id.
PARTS = 2


class DigestIndex:
    """Digests seen so far, with the document that stands for each of them."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """``path`` names a folder to keep or reopen; the same ``buckets`` must be given each time."""
        self.spark = spark
        self.path = path or scratch(spark, "digest-index")
        self.buckets = buckets or shuffle_partitions(spark)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING, keep_row BIGINT)"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, entries: DataFrame) -> None:
        """Add entries whose digests are new; dealt by bucket, so each bucket gets one file."""
        columns = ("digest", "keep_id", "group_size", "batch", "keep_row")
        entries.select(*columns).repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Take the table's name out of the catalog; its folder stays and can be reopened."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(docs: DataFrame, index: DigestIndex, columns: list[str] | None = None, parts: int = 1) -> DataFrame:
    """Every row of ``docs`` with :data:`RESULTS`; appends what is new to ``index``.

    ``columns`` limits what is carried along (default: all of ``docs``); the text is read once. ``parts`` loads the
    batch in so many ranges of ``doc_id``, largest first, each against what the index then holds; the result is
    the same for any number.
    """
    carried = others(docs.select(*columns) if columns is not None else docs, RESULTS)
    rows = staged(
        docs.select(
            F.sha2(ascii_lower(F.col("text")).cast("binary"), 256).alias("_digest"),
            F.monotonically_increasing_id().alias("_row"),
            F.col("doc_id").cast("long").alias("_doc"),
            boxed(carried),
        ),
        "digests",
    )
    batch = uuid.uuid4().hex
    for part in _parts(rows, parts):
        groups = part.groupBy(F.col("_digest").alias("digest")).agg(
            F.max(F.struct("_doc", "_row")).alias("_keeper"), F.count("*").alias("group_size")
        )
        fresh = groups.select(
            "digest",
            F.col("_keeper._doc").alias("keep_id"),
            "group_size",
            F.lit(batch).alias("batch"),
            F.col("_keeper._row").alias("keep_row"),
        )
        index.append(fresh.join(index.read().hint("merge"), "digest", "left_anti"))
    # What the index says of each digest, whichever batch brought it; read again below, so it is written once.
    sizes = rows.groupBy("_digest").agg(F.count("*").alias("_size"))
    entries = index.read().withColumnRenamed("digest", "_digest").withColumn("_ours", F.col("batch") == batch)
    verdicts = staged(
        sizes.join(entries.hint("merge"), "_digest").select(
            "_digest",
            "keep_id",
            F.when(F.col("_ours"), F.col("_size")).otherwise(F.col("group_size") + F.col("_size")).alias("group_size"),
            F.when(F.col("_ours"), F.col("keep_row")).alias("_keep_row"),
        ),
        "verdicts",
    )
    # Both sides are plain shuffles here: adaptive execution splits a digest that a third of the rows carry.
    return rows.join(verdicts.hint("merge"), "_digest").select(
        *unboxed(carried),
        "keep_id",
        "group_size",
        F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(False)).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def _parts(rows: DataFrame, parts: int) -> list[DataFrame]:
    """``rows`` in ``parts`` ranges of ``_doc``, largest first; rows without one are in the last."""
    if parts == 1:
        return [rows]
    at = [1 - i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("_doc", at).alias("cuts")).first()["cuts"]
    if cuts is None:
        return [rows]
    number = F.lit(parts - 1)
    for i, cut in reversed(list(enumerate(cuts))):
        number = F.when(F.col("_doc") > cut, F.lit(i)).otherwise(number)
    return [rows.filter(number == i) for i in range(parts)]


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    whole = docs.select("doc_id", "text", boxed(docs.columns))
    index = DigestIndex(docs.sparkSession)
    kept = deduplicate(whole, index, ["_box"], PARTS).filter("kept")
    index.close()
    return kept.select(*unboxed(docs.columns))
