"""One query per corpus operator over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyground.llm import (
    code_search,
    exact_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    piece_codec,
    quality_rules,
    secret_scan,
    suffix_dedup,
    url_lists,
    whitening,
)
from skyground.llm.common import table


def code_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_search.search(table(spark, sf_dir, "embeddings"))


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = exact_dedup.DigestIndex(spark)
    out = exact_dedup.deduplicate(docs, index, columns=["doc_id"], parts=exact_dedup.PARTS)
    index.close()
    return out


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = line_dedup.remove_boilerplate(docs)
    return out.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def secret_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secret_scan.scan(docs, by_docs=True).drop("source")


def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def piece_codec_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list events derived from the hosts of the pages and their first path segments."""
    url = F.col("url")
    host = url_lists.host_of(url)
    hosts = pages.select(host.alias("host"), F.split(url_lists.path_of(url), "/")[1].alias("segment")).dropna()
    start = F.to_timestamp(F.lit("2024-01-01"))
    code = lambda text: F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")
    day = lambda n: F.timestamp_add("DAY", n, start)
    named = hosts.select("host").distinct().withColumn("c", code(F.col("host")))
    parents = named.select(F.array_join(F.slice(F.split("host", r"\."), -2, 2), ".").alias("host")).distinct()
    parents = parents.withColumn("c", code(F.col("host")))
    sections = (
        hosts.filter("segment <> ''").distinct().select(F.concat_ws("/", "host", "segment").alias("host"))
    ).withColumn("c", code(F.col("host")))

    def events(rows: DataFrame, kind: str, verdict: str, every: int) -> DataFrame:
        listed = F.col("c") % 200
        steps = F.array(
            F.struct(F.lit("add").alias("action"), listed.alias("n")),
            F.struct(F.lit("remove").alias("action"), (listed + 60).alias("n")),
            F.struct(F.lit("add").alias("action"), (listed + 120).alias("n")),
        )
        return (
            rows.filter(F.col("c") % every == 0)
            .select(F.col("host").alias("pattern"), F.explode(steps).alias("s"))
            .select(
                F.lit(kind).alias("kind"),
                "pattern",
                "s.action",
                F.lit(verdict).alias("verdict"),
                day(F.col("s.n")).alias("at"),
            )
        )

    return (
        events(named, "host", "block", 2)
        .union(events(parents, "domain", "block", 3))
        .union(events(sections, "prefix", "allow", 3))
    )


def url_lists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = (F.col("page_id") * 7919 % 365).cast("int")
    captures = pages.withColumn(
        "fetched_at", F.timestamp_add("DAY", day, F.to_timestamp(F.lit("2024-01-01")))
    )
    out = url_lists.judge(captures, list_events(pages))
    return out.select("page_id", "host", "verdict", "kind", "pattern", "n_active")


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which of several broken rules is named depends on measured times, so it is no part of the result.
    return quality_rules.report(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "rejected_by")


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_code_search": code_search_query,
    "op2_exact_dedup": exact_dedup_query,
    "op3_language_id": language_id_query,
    "op4_line_dedup": line_dedup_query,
    "op5_secret_scan": secret_scan_query,
    "op6_ngram_join": ngram_join_query,
    "op7_suffix_dedup": suffix_dedup_query,
    "op8_packing": packing_query,
    "op9_piece_codec": piece_codec_query,
    "op10_url_lists": url_lists_query,
    "op11_whitening": whitening_query,
    "op12_quality_rules": quality_rules_query,
    "op13_hard_negatives": hard_negatives_query,
}
