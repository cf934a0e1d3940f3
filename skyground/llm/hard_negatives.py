"""Hard negatives by exact integer scores from residue-number matrix products.

Components become whole numbers, floor(scale * x). An anchor's score with a row is their inner product, computed as
one float32 matrix product per small prime on symmetric residues: a product of 64 residues below 512 stays below 2^24, so
every partial sum is exact, and longer vectors are multiplied in runs of 64 that are reduced between. Chinese remaindering
puts the signed score together. There are as many primes as the largest norm of the table asks for (Cauchy-Schwarz), so no
score can wrap around.

Two rounds over pairs of blocks: the first finds each anchor's positives, the second, with the scores of those known, each
positive's window of negatives. Blocks send on their best few of each anchor (and positive), a window over all blocks
selects. Rows and anchors are dealt to blocks by a hash of the row's number, whatever their labels, so a label that holds
a third of the rows is spread like any other, and no group is larger than a block of either side. Every pair is scored in
both rounds; nothing is sampled or capped.

Defined cases: rows with a null id, label or vector, or with a component that is null, not finite, or of 65,536
and more at scale 256 (2^24 / scale), take no part; vectors meet vectors of their own length only; rows that share the anchor's id are
its own and neither its positives nor negatives; rows that repeat an id are rows each, repeated
anchors too; ties go to the smaller id; an anchor without positives, or a positive with an empty window, gives no rows; an empty table
gives none. Only ``vec_id``, ``label`` and ``embedding`` are read, further columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyground.llm.common import staged

SCALE = 256
#: Components of that many whole units and more would not leave room for a score in a long.
LARGEST = 1 << 24
#: So many products of residues below 512 sum up to less than 2^24, which float32 holds exactly.
RUN = 64
BLOCK = 8192
ANCHOR_BLOCK = 8192
TILE = 256
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@lru_cache(1)
def _primes() -> list[int]:
    """Primes below 1024, the largest first."""
    return [n for n in range(1023, 2, -2) if all(n % d for d in range(3, math.isqrt(n) + 1, 2))]


def moduli(bound: int) -> list[int]:
    """Primes whose product exceeds ``2 * bound + 1``, so that scores from -bound to bound are told apart."""
    chosen, product = [], 1
    for p in _primes():
        if chosen and product > 2 * bound + 1:
            break
        chosen.append(p)
        product *= p
    return chosen


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """``x`` modulo each prime, from -(p - 1) / 2 to (p - 1) / 2, as float32."""
    out = []
    for p in primes:
        r = np.mod(x, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def _modular_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, somewhere between -p and p, exact in float32."""
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, a.shape[1], RUN):
        part = a[:, at : at + RUN] @ b[:, at : at + RUN].T
        part -= np.float32(p) * np.rint(part / np.float32(p))
        total += part
        total -= np.float32(p) * np.rint(total / np.float32(p))
    return total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of two residue matrices, as int64.

    Garner's form of Chinese remaindering with symmetric digits, so that signs need no care. What wraps around in int64
    on the way comes back, as the result fits.
    """
    out = _modular_product(a[0], b[0], primes[0]).astype(np.int64)
    out -= primes[0] * np.rint(out / primes[0]).astype(np.int64)
    base = primes[0]
    for i, p in enumerate(primes[1:], 1):
        digit = _modular_product(a[i], b[i], p).astype(np.int64) - out % p
        digit *= pow(base, -1, p)
        digit %= p
        digit[digit > p // 2] -= p
        out += digit * np.int64((base + (1 << 63)) % (1 << 64) - (1 << 63))
        base *= p
    return out


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(table), dims)


def _pairs(rows: pa.Table, anchors: pa.Table, bounds: dict[int, int]):
    """Tiles of anchors with their scores; a pair of the same id scores as None through ``own``."""
    dims = rows["dims"][0].as_py()
    primes = moduli(bounds[dims])
    right = residues(_matrix(rows, dims), primes)
    left = residues(_matrix(anchors, dims), primes)
    for at in range(0, len(anchors), TILE):
        yield at, scores([m[at : at + TILE] for m in left], right, primes)


def _first(score: np.ndarray, ids: np.ndarray, some: np.ndarray, k: int) -> np.ndarray:
    """The best k of the rows ``some``, higher scores first, then smaller ids."""
    if len(some) > k:
        least = np.partition(score[some], len(some) - k)[len(some) - k]
        some = some[score[some] >= least]
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy() for n in names]


def _positives(bounds: dict[int, int], k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(rows) and len(anchors):
            ids, labels = _columns(rows, "vec_id", "label")
            a_row, a_id, a_label = _columns(anchors, "row", "vec_id", "label")
            for at, tile in _pairs(rows, anchors, bounds):
                for j, score in enumerate(tile, at):
                    some = np.flatnonzero((labels == a_label[j]) & (ids != a_id[j]))
                    found.extend((a_row[j], ids[i], score[i]) for i in _first(score, ids, some, k).tolist())
        return pa.table(
            [pa.array([int(x[c]) for x in found], pa.int64()) for c in range(3)],
            names=["row", "positive_id", "positive_score"],
        )

    return run


def _negatives(bounds: dict[int, int], k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(rows) and len(anchors):
            ids, labels = _columns(rows, "vec_id", "label")
            a_row, a_id, a_label = _columns(anchors, "row", "vec_id", "label")
            positives = anchors["positives"].to_pylist()
            for at, tile in _pairs(rows, anchors, bounds):
                for j, score in enumerate(tile, at):
                    # Whole numbers s with low * p <= 100 * s <= high * p.
                    spans = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives[j]]
                    least, most = min(s[0] for s in spans), max(s[1] for s in spans)
                    near = (score >= least) & (score <= most) & (labels != a_label[j]) & (ids != a_id[j])
                    some = np.flatnonzero(near)
                    for p, (first, last) in zip(positives[j], spans, strict=True):
                        inside = some[(score[some] >= first) & (score[some] <= last)]
                        found.extend((a_row[j], p["place"], ids[i], score[i]) for i in _first(score, ids, inside, k).tolist())
        return pa.table(
            [pa.array([int(x[c]) for x in found], pa.int64()) for c in range(4)],
            names=["row", "place", "negative_id", "negative_score"],
        )

    return run


def valid(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector, dims`` of the rows that take part, components as whole numbers."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LARGEST)
    return (
        vectors.select(
            F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("_v")
        )
        .dropna()
        .filter(F.forall("_v", usable))
        .select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * scale).cast("int")).alias("vector"))
        .withColumn("dims", F.size("vector"))
    )


def mine(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = SCALE,
    block: int = BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """Per anchor (id divisible by ``every``) and positive (the first ``positives`` rows of its label) the first ``negatives``
    rows of other labels whose scores are from ``low`` to ``high`` per cent of the positive's."""
    spark = vectors.sparkSession
    rows = staged(valid(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    # Per length of vector: rows, anchors, and the largest squared norm, which bounds every score. The norm is summed in
    # doubles, to which one part in 2^40 and one are added for what rounding may take.
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    asked = F.col("vec_id") % every == 0
    facts = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("a"), F.max(square).alias("most"))
    sizes = {r["dims"]: r for r in facts.collect()}
    if not any(r["a"] for r in sizes.values()):
        return spark.createDataFrame([], RESULT)
    bounds = {d: int(r["most"] * (1 + 2.0**-40)) + 1 for d, r in sizes.items()}
    blocks = {d: -(-r["n"] // block) for d, r in sizes.items()}
    parts = {d: max(1, -(-r["a"] // anchor_block)) for d, r in sizes.items()}
    of = lambda counts: F.create_map(*[F.lit(x) for d in counts for x in (d, counts[d])])[F.col("dims")]
    spread = F.xxhash64("row")
    left = rows.withColumn("block", F.pmod(spread, of(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), of(parts) - 1))
    )
    key = ["dims", "block", "part"]

    def paired(anchors: DataFrame, task, schema: str) -> DataFrame:
        right = anchors.withColumn("part", F.pmod(spread, of(parts)).cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), of(blocks) - 1))
        )
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(task, schema)

    # Aliases make the anchors' columns their own: both sides of a pair come from one table.
    anchors = rows.filter(asked).select(*[F.col(c).alias(c) for c in rows.columns])
    near = paired(anchors, _positives(bounds, positives), "row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    chosen = staged(
        near.withColumn("place", F.row_number().over(order).cast("long")).filter(F.col("place") <= positives), "positives"
    )
    wanted = chosen.groupBy("row").agg(
        F.collect_list(F.struct("place", F.col("positive_score").alias("score"))).alias("positives")
    )
    hard = paired(
        anchors.join(wanted, "row"),
        _negatives(bounds, negatives, low, high),
        "row long, place long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    picked = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return (
        picked.join(chosen, ["row", "place"])
        .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
