"""N-gram classes, repeated strings, code search and languages against brute force."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyground.llm import code_search, components, language_id, ngram_join, suffix_dedup
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_classes(rows):
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = collections.Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[root(i)] if rows[j][0] is not None]
        out[doc_id, len(sets[i]), min(ids, default=None)] += 1
    return out


def near_rows():
    rows = []
    for g in range(6):
        words = sentence(g + 10, 120).split()
        for k in range(12):
            changed = list(words)
            for i in range(k % 5):
                changed[(17 * k + 29 * i) % 120] = f"x{g}{k}{i}"
            rows.append((100 * g + k, " ".join(changed)))
    # A passage that many otherwise different texts share.
    shared = sentence(99, 40)
    rows += [(1000 + i, sentence(200 + i, 60) + " " + shared) for i in range(30)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"COMMON": 4, "SHORT": 3, "TOGETHER": 20, "TREE": 2, "MOST_COMMON": 100}])
def test_classes(spark, documents, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    if limits:
        monkeypatch.setattr(ngram_join.common_grams, "__defaults__", (5, 4, 100))
    rows = [(r.doc_id, r.text) for r in documents.collect()] + near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute_classes(rows)


def test_keep_one(spark, clashing, nothing):
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    # 4, 5 and 6 are near copies, 7 and 8, 9 and 10; each text without words stays.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 9, 11, 12]
    assert ngram_join.keep_one(nothing).count() == 0
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}


def test_walk_agrees_with_intersection():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 500, 200).astype(np.uint64))
    sets = []
    for _ in range(60):
        keep = rng.random(len(base)) < rng.choice([0.7, 0.9, 0.97])
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 500, 8).astype(np.uint64)])))
    want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(base, s)) >= 75 * len(np.union1d(base, s))]
    assert sorted(ngram_join.walk(base, sets, 75)) == want and 0 < len(want) < 60


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(5)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    apart = 0
    for n in (1, 2, 63, 64, 65, 127, 129, 500, 513, 3000):
        for own_a, own_b in ((0, 0), (0, n // 3), (n // 7, n // 7), (n, n), (n, 3 * n)):
            both = draw(n)
            a, b = (np.unique(np.concatenate([both, draw(k)])) for k in (own_a, own_b))
            bound = ngram_join.most_shared(ngram_join.parities(a), ngram_join.parities(b), len(a), len(b))
            assert len(np.intersect1d(a, b)) <= bound <= (len(a) + len(b)) // 2
            apart += bound < ngram_join.needed(len(a), len(b), 75)
        assert bound < ngram_join.needed(len(a), len(b), 75) or n < 63
    assert apart > 10


def test_sets_that_cannot_link_do_not_move(spark, monkeypatch):
    """Texts that share a passage are candidates; their sets stay where they are, and those that moved are removed again."""
    tables, stage = [], ngram_join.staged

    def counted(df, name):
        out = stage(df, name)
        tables.append((name, out.count(), out._staged_at))
        return out

    monkeypatch.setattr(ngram_join, "staged", counted)
    shared = sentence(98, 40)
    rows = [(i, sentence(4000 + i, 60) + " " + shared) for i in range(8)]
    rows += [(100 + i, sentence(4100, 100) + f" {i}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute_classes(rows)
    assert sum(n for name, n, _ in tables if name == "pairs") > 1
    sets = [(n, at) for name, n, at in tables if "sets" in name]
    assert [n for n, _ in sets] == [2]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sets[0][1])
    assert not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files)


def brute_repeats(rows, length):
    count = collections.Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = collections.Counter()
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out[doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length,crowd", [(60, 1024), (60, 3), (33, 2), (400, 1024)])
def test_repeats(spark, documents, monkeypatch, length, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1000)
    passage = sentence(77, 60)
    rows = [(r.doc_id, (r.text or "")[:3000]) for r in documents.collect()]
    rows += [(300 + i, sentence(300 + i, 20) + passage[i * 3 :] + "é" * i) for i in range(12)]
    rows += [(400, "ab" * 500), (401, "z" * 900), (402, passage[: length - 1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in suffix_dedup.digests(docs, length).collect())
    assert got == brute_repeats(rows, length)


def test_a_crowd_does_not_meet_in_one_task(spark, monkeypatch):
    crowd, order = 20, suffix_dedup._order

    def bounded(length):
        run = order(length)

        def check(batches):
            seen = collections.Counter()
            for batch in batches:
                seen.update(batch.column(0).to_pylist())
                assert max(seen.values()) <= crowd
                yield from run(iter([batch]))

        return check

    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "_order", bounded)
    line = sentence(55, 30)
    rows = [(i, sentence(500 + i, 40) + line + sentence(900 + i, 40)) for i in range(200)]
    rows += [(300 + i, f"{i} " + rows[i][1][:-7]) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in suffix_dedup.digests(docs).collect())
    assert got == brute_repeats(rows, 400)


def test_a_crowd_is_halved_by_offset(spark, monkeypatch):
    """Passages of more than a window amid different text: few rows an interval, not one a window."""
    levels, stage = [], suffix_dedup.staged

    def counted(df, name):
        out = stage(df, name)
        if name == "pieces":
            levels.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "CROWD", 20)
    monkeypatch.setattr(suffix_dedup, "staged", counted)
    line = sentence(56, 60)[:470]
    rows = [(i, sentence(2000 + i, 50) + line + sentence(3000 + i, 50)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in suffix_dedup.digests(docs).collect())
    assert got == brute_repeats(rows, 400)
    windows = 150 * (470 - 400 + 1)
    assert 1 < len(levels) <= 9 and sum(levels) < windows / 2


def test_repeats_of_nothing(spark, nothing, clashing):
    assert suffix_dedup.digests(nothing).count() == 0
    assert suffix_dedup.digests(clashing).count() == clashing.count()


def test_difference_cover_order():
    rng = np.random.default_rng(1)
    for length in (32, 41, 100, 400):
        base = rng.integers(97, 99, 600, dtype=np.uint8)
        text = np.concatenate([rng.integers(97, 100, 700, dtype=np.uint8), base, base[5:590], np.full(500, 97, np.uint8)])
        starts = np.arange(len(text) - length + 1)
        count = collections.Counter(text[i : i + length].tobytes() for i in starts)
        want = [count[text[i : i + length].tobytes()] > 1 for i in starts]
        assert suffix_dedup.starts_again(text, starts, length).tolist() == want


def test_search_recall_and_cases(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((700, 48))
    x[300:500] = x[300]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [
        (900, None),
        (920, [0.0] * 48),
        (940, [float("nan")] * 48),
        (960, [None] * 48),
        (980, [1.0, 2.0]),
        (981, [2.0, 1.0]),
        (1000, []),
        (None, [1.0] * 48),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = collections.defaultdict(list)
    for r in code_search.search(vectors, block=200).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = {980: [(981, 4.0)]}
    for q in range(0, 700, 20):
        scores = np.array([np.cumsum(x[q] * r)[-1] for r in x])
        order = [i for i in np.lexsort((np.arange(700), -scores)) if i != q][:20]
        want[q] = [(i, scores[i]) for i in order]
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))
    assert hits >= 0.99
    assert code_search.search(vectors.limit(0)).count() == 0


def test_search_with_one_id_repeated(spark):
    rng = np.random.default_rng(12)
    same = [float(v) for v in rng.standard_normal(16)]
    rows = [(0, same)] * 30 + [(i, same) for i in range(1, 46)]
    rows += [(i, [float(v) for v in rng.standard_normal(16)]) for i in range(100, 160)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in code_search.search(vectors).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[0] == [i for i in range(1, 21) for _ in range(30)][:20]
    assert got[20] == got[40] == [0] * 20


def test_languages(spark, clashing, nothing):
    words = {"en": "the and of with thing", "fr": "le la des être avoir", "de": "der die und nicht schön"}
    rows = [
        (i, " ".join(np.random.default_rng(i).permutation((words[k] + f" {i}").split() * 4)), k)
        for i, k in enumerate(["en", "fr", "de"] * 60)
    ]
    rows += [(500, None, "en"), (501, "123 !!", "fr"), (502, "", None), (503, "être des la", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for i, _, lang in rows[:180]:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang and 0 < got[i].score <= 1
    assert [(got[i].lang_pred, got[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[503].lang_pred == "fr"
    assert language_id.identify(nothing).count() == 0
    assert language_id.identify(clashing).count() == clashing.count()
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_rare_languages_and_repeated_ids_are_drawn(spark):
    assert language_id.bounds({"a": 1000, "b": 3, "c": 500}, 103) == {"b": 3, "c": 50, "a": 50}
    rows = [(i, f"the and of with thing {i}", "en") for i in range(3000)]
    rows += [(7, f"der die und nicht {i}", "de") for i in range(3000)]
    rows += [(10_000 + i, "être avoir là forêt", "fr") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(language_id.learn(docs, 106)) == {"de", "en", "fr"}


def test_bundle_is_the_sum_of_bound_letters():
    grams, which, owner = language_id.grams_of(["abç", ""])
    vectors = language_id.gram_vectors(grams, 64).astype(int)
    letter = lambda c: language_id.letter_vector(ord(c), 64).astype(int)
    want = sum(
        np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in (" ab", "abç", "bç ")
    )
    assert (vectors[which].sum(axis=0) == want).all() and set(owner.tolist()) == {0}


def test_held_out_labels_teach_nothing(spark):
    rows = [(i, f"alpha beta {i}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert {r.lang_pred for r in language_id.identify(wrong).collect()} == {"en"}
