"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import collections

import corpus_pipeline
from skyground.llm import language_id, packing, secret_scan
from tests.llm.test_similar import LOWER, brute_classes


def test_stages(spark, documents, tmp_path):
    documents.union(documents.limit(3)).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.dtypes == docs.dtypes
        kept[name] = [tuple(r) for r in now.collect()]
    start = [tuple(r) for r in docs.collect()]
    # Texts without letters go; nothing else does.
    want = [r for r in start if any(c.isalpha() for c in r[1] or "")]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(kept["language_id"], key=key) == sorted(want, key=key)
    best = {}
    for r in want:
        text = r[1].translate(LOWER)
        best[text] = max(best.get(text, (-1,)), (-1 if r[0] is None else r[0],))
    assert collections.Counter((-1 if r[0] is None else r[0]) for r in kept["exact_dedup"]) == collections.Counter(
        v[0] for v in best.values()
    )
    classes = {c[2] for c in brute_classes([(r[0], r[1]) for r in kept["exact_dedup"]])}
    assert {r[0] for r in kept["ngram_join"]} == classes
    assert len(kept["ngram_join"]) == len(classes)
    assert [r[0] for r in sorted(kept["secret_scan"], key=key)] == [r[0] for r in sorted(kept["ngram_join"], key=key)]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == classes
    assert out[0].asDict().keys() >= {"doc_id", "piece", "start", "length", "sequence_id", "offset"}


def test_stages_are_the_five(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "exact_dedup",
        "ngram_join",
        "secret_scan",
        "packing",
    ]
    assert language_id.UNKNOWN == "und" and packing.CAPACITY == 2048 and secret_scan.MAX_OWNERS == 1
