"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a generator seeded by its code point. An n-gram
is bound by multiplying its letters' vectors, each permuted (rotated) once more than the next, so that order
counts. A text's vector is the bundle (sum) of its n-grams' vectors, a language's prototype the bundle of its
documents, each weighted by the inverse of its length. The prediction is the language whose prototype has the largest
cosine with the text's vector.

Counting n-grams first and binding each distinct one once per slice of texts gives the same sums as adding vectors
letter by letter. Training adds counts per language in the tasks and vectors over tasks; what
reaches the driver are prototypes, ``dims`` numbers per language.

Defined cases: null text, and text without letters, is ``und`` with score 0; equal cosines go to the
language first in order; rows without ``lang`` teach nothing; without any labelled row everything is ``und``; repeated
rows count each. Only letters count: case is lowered, runs of anything else become one blank.
Columns beyond those named are carried along unless a result column has their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyground.llm.chunks import slices
from skyground.llm.common import free_name, others

DIMS = 1024
N = 3
#: Rows to learn from, about, over all languages; all of them where there are fewer. Each language has the same
#: bound, and what rare ones leave of theirs goes to the others.
FIT_ROWS = 50_000
UNKNOWN = "und"
BLANK = 0x20
BLOCK = 128
RESULTS = ("lang_pred", "score")


@lru_cache(4096)
def letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.default_rng(code).integers(0, 2, dims, np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dims: int) -> np.ndarray:
    """One bound vector per row of letters; the first letter is rotated most."""
    letters, where = np.unique(grams, return_inverse=True)
    base = np.stack([letter_vector(int(c), dims) for c in letters])
    where = where.reshape(grams.shape)
    out = np.ones((len(grams), dims), np.int8)
    for i in range(grams.shape[1]):
        out *= np.roll(base, grams.shape[1] - 1 - i, axis=1)[where[:, i]]
    return out


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams_of(texts: list[str], n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of all texts (rows of code points), and for each n-gram read, in order: its place
    among them, and its text's. Each text is set between blanks."""
    # NUL is no letter; it stands between texts and is never part of an n-gram.
    joined = "\0 " + " \0 ".join(t.replace("\0", " ").lower() for t in texts) + " \0"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    kept, stop = _letters()[codes], codes == 0
    # Of each run of other characters one stays, as a blank.
    keep = kept | stop
    keep[1:] |= kept[:-1] | stop[:-1]
    owner = (np.cumsum(stop) - 1)[keep]
    codes = np.where(kept | stop, codes, BLANK)[keep]
    found = np.zeros(int(codes.max()) + 1, bool)
    found[codes] = True
    alphabet = np.flatnonzero(found)
    small = (np.cumsum(found) - 1)[codes]
    size, many = len(alphabet), len(small) - n + 1
    if many < 1:
        return np.zeros((0, n), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.zeros(many, np.int64)
    fine = np.ones(many, bool)
    for i in range(n):
        key = key * size + small[i : many + i]
        fine &= codes[i : many + i] != 0
    key, owner = key[fine], owner[:many][fine]
    if size**n <= 1 << 24:
        used = np.zeros(size**n, bool)
        used[key] = True
        distinct = np.flatnonzero(used)
        which = (np.cumsum(used, dtype=np.int32) - 1)[key]
    else:
        distinct, which = np.unique(key, return_inverse=True)
    rows = np.stack([alphabet[distinct // size ** (n - 1 - i) % size] for i in range(n)], axis=1)
    return rows, which, owner


def _sums(lang: list, texts: list[str], dims: int, n: int) -> Iterator[tuple[str, np.ndarray, int]]:
    """Bundles of the texts of each language, each text weighted by the inverse of its length."""
    grams, which, owner = grams_of(texts, n)
    if not len(grams):
        return
    total = np.bincount(owner, minlength=len(texts))
    langs, number = np.unique(np.array(lang), return_inverse=True)
    size = len(grams)
    weights = np.bincount(number[owner] * size + which, 1 / total[owner], len(langs) * size)
    bundles = weights.reshape(len(langs), size).astype(np.float32) @ gram_vectors(grams, dims).astype(np.float32)
    for i, name in enumerate(langs.tolist()):
        yield name, bundles[i].astype(np.float64), int(((number == i) & (total > 0)).sum())


def bounds(counts: dict[str, int], fit_rows: int) -> dict[str, int]:
    """Rows of each language to learn from: all of a rare one, equal shares of what is left for the others, one at least."""
    out, left = {}, fit_rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, max(1, left // (len(counts) - i)))
        left -= out[lang]
    return out


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS, dims: int = DIMS, n: int = N) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages in ``docs`` (``doc_id, text, lang``); about ``fit_rows`` rows are read (:func:`bounds`)."""
    labelled = docs.filter(F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    shares = [(k, n / counts[k]) for k, n in bounds(counts, fit_rows).items() if n < counts[k]]
    drawn = labelled
    if shares:
        # By a hash of its own, so that the draw has nothing to do with the held-out remainder; with the text, so that
        # rows that share an id are drawn apart. Languages that are not cut have no entry and stay whole.
        limit = F.create_map(*[F.lit(x) for k, part in shares for x in (k, int(part * (1 << 40)))])
        place = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1 << 40))
        drawn = labelled.filter(place < F.coalesce(F.try_element_at(limit, F.col("lang")), F.lit(1 << 40)))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for at, texts in slices(batch.column(0)):
                lang = batch.column(1).slice(at, len(texts)).to_pylist()
                for name, vector, rows in _sums(lang, texts.fill_null("").to_pylist(), dims, n):
                    old = sums.setdefault(name, [np.zeros(dims), 0])
                    old[0] += vector
                    old[1] += rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sums, pa.string()),
                pa.array([s[0] for s in sums.values()], pa.list_(pa.float64())),
                pa.array([s[1] for s in sums.values()], pa.int64()),
            ],
            names=["lang", "vector", "rows"],
        )

    parts = drawn.select("text", "lang").mapInArrow(bundle, "lang string, vector array<double>, rows long")
    places = (
        parts.select("lang", "rows", F.posexplode("vector").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"), F.sum("rows").alias("rows"))
    )
    whole = places.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("vector"),
        F.max("rows").alias("rows"),
    )
    learnt = {}
    for row in whole.filter("rows > 0").orderBy("lang").collect():
        vector = np.array(row["vector"])
        if np.linalg.norm(vector):
            learnt[row["lang"]] = vector / np.linalg.norm(vector)
    return learnt


def predict(docs: DataFrame, learnt: dict[str, np.ndarray], n: int = N) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: the cosine, or 0 if negative), in one pass without shuffle."""
    carried = others(docs, RESULTS)
    names = list(learnt)
    protos = np.stack([learnt[k] for k in names]).astype(np.float32) if names else np.zeros((0, 1), np.float32)
    dims = protos.shape[1]

    def judge(texts: list[str]) -> tuple[list[str], list[float]]:
        pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        grams, which, owner = grams_of(texts, n)
        if not len(grams) or not names:
            return pred, score
        vectors = gram_vectors(grams, dims).astype(np.float32)
        for at in range(0, len(texts), BLOCK):
            lo, hi = np.searchsorted(owner, [at, at + BLOCK])
            size = min(BLOCK, len(texts) - at)
            counts = np.bincount((owner[lo:hi] - at) * len(grams) + which[lo:hi], minlength=size * len(grams))
            counts = counts.reshape(size, len(grams))
            used = np.flatnonzero(counts.any(axis=0))
            bundles = counts[:, used].astype(np.float32) @ vectors[used]
            norms = np.linalg.norm(bundles, axis=1)
            cosines = bundles @ protos.T / np.where(norms > 0, norms, 1)[:, None]
            best = np.argmax(cosines, axis=1)
            for i in np.flatnonzero(norms > 0).tolist():
                pred[at + i] = names[best[i]]
                score[at + i] = float(min(1.0, max(0.0, cosines[i, best[i]])))
        return pred, score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred: list[str] = []
            score: list[float] = []
            for _, texts in slices(batch.column(len(carried))):
                p, s = judge(texts.fill_null("").to_pylist())
                pred += p
                score += s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*carried, *RESULTS],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in carried)
    return docs.select(*carried, F.col("text").alias(free_name(carried))).mapInArrow(
        run, f"{kinds}, lang_pred string, score double"
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS, dims: int = DIMS, n: int = N) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``held_out``, learnt from the rows not held out."""
    learnt = learn(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), fit_rows, dims, n)
    return predict(docs, learnt, n).withColumn("held_out", held_out(F.col("doc_id")))
