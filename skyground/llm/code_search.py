"""Nearest neighbours by randomly rotated one-bit codes.

The index holds for each vector the signs of its rotated, centred form as packed bits, and scalars that correct the
estimate: the residual's norm, and the inner product of the unit residual with its own code. For a query, the inner
product with a row is estimated from the row's bits and scalars, with a bound on the error
that fails with the probability ``WIDTH`` stands for. In each block of rows the best few by estimate are computed
exactly, and their k-th is a threshold: every row whose upper bound reaches it is reranked by its exact
inner product in double precision, and the block's best k go on. The best k over all blocks are the result.

Rows are dealt evenly to blocks and queries to query blocks, each pair of blocks is one group of bounded size, and all
rows of the table are in some block; nothing is capped. Of equal vectors in a block only k rows
of an id, and of those the 2k with the smallest ids, can be among the nearest, as ties go to the smaller id and a query
leaves out no more than its own id's; the rest are left out of the computation. What the index learns from the table is its mean, summed in the tasks.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite components take no part; vectors
meet vectors of their own length only; rows with a null id take no part; rows that share the query's id
are the query's own; rows that repeat an id are candidates each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyground.llm.common import staged

K = 20
#: Standard errors on either side of an estimate.
WIDTH = 3.0
BLOCK = 8192
QUERY_BLOCK = 2048
PART = 128
SEED = 7
FOUND = "query_id long, vec_id long, score double"


@lru_cache(8)
def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dims)).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector, dims`` of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
        .withColumn("dims", F.size("vector"))
    )


def means(rows: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Number of rows and mean vector for each length of vector; one sum per task reaches the aggregation."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for dims in np.unique(sizes).tolist():
                block = _matrix(batch.column(0).filter(pa.array(sizes == dims)), dims)
                sums[dims] = sums.get(dims, 0) + block.sum(axis=0)
                counts[dims] = counts.get(dims, 0) + len(block)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sums, pa.int32()),
                pa.array(list(sums.values()), pa.list_(pa.float64())),
                pa.array(counts.values(), pa.int64()),
            ],
            names=["dims", "total", "n"],
        )

    parts = rows.select("vector", "dims").mapInArrow(add, "dims int, total array<double>, n long")
    places = (
        parts.select("dims", "n", F.posexplode("total").alias("at", "x"))
        .groupBy("dims", "at")
        .agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    )
    out: dict[int, list] = {}
    for r in places.orderBy("dims", "at").collect():
        out.setdefault(r["dims"], [r["n"], []])[1].append(r["x"] / r["n"])
    return {d: (n, np.array(mean)) for d, (n, mean) in out.items()}


def index(rows: DataFrame, centres: dict[int, tuple[int, np.ndarray]], block: int = BLOCK) -> DataFrame:
    """``rows`` with packed ``code``, ``norm`` and ``fit``, dealt to blocks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            codes = np.empty(len(sizes), object)
            norm, fit = np.zeros(len(sizes)), np.ones(len(sizes))
            for dims in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dims)
                rest = _matrix(batch.column(1).take(pa.array(mine)), dims) - centres[dims][1]
                norm[mine] = np.linalg.norm(rest, axis=1)
                unit = rest / np.where(norm[mine] > 0, norm[mine], 1)[:, None] @ rotation(dims).T
                for i, bits in zip(mine.tolist(), np.packbits(unit > 0, axis=1), strict=True):
                    codes[i] = bits.tobytes()
                # Never zero: the absolute sum of a unit vector is 1 at least; a row at the centre has norm 0.
                fit[mine] = np.maximum(np.abs(unit).sum(axis=1) / np.sqrt(dims), 1e-3)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(norm), pa.array(fit)],
                names=["vec_id", "vector", "dims", "code", "norm", "fit"],
            )

    coded = rows.select("vec_id", "vector", "dims").mapInArrow(
        encode, "vec_id long, vector array<double>, dims int, code binary, norm double, fit double"
    )
    blocks = F.create_map(*[F.lit(x) for d, (n, _) in centres.items() for x in (d, -(-n // block))])
    # By a hash of the row's number, so that repeated ids and vectors spread as well.
    return coded.withColumn(
        "block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), blocks[F.col("dims")]).cast("int")
    )


def _few_copies(table: pa.Table, k: int) -> pa.Table:
    """``table`` without the copies of vectors that no query needs, ordered by id.

    Of each vector at most k rows of an id stay, and of those the first 2k by id: k without any one id.
    """
    table = table.sort_by("vec_id")
    dims = table["dims"][0].as_py()
    raw = _matrix(table["vector"].combine_chunks(), dims)
    _, group, count = np.unique(raw.view(f"V{8 * dims}").ravel(), return_inverse=True, return_counts=True)
    if count.max() <= k + 1:
        return table
    ids = table["vec_id"].to_numpy()
    order = np.argsort(group, kind="stable")

    def first(n: int, *keys: np.ndarray) -> np.ndarray:
        """``order`` with the first n of each run of equal keys."""
        at = np.arange(len(order))
        starts = np.concatenate([[True], np.any([x[order][1:] != x[order][:-1] for x in keys], axis=0)])
        return order[at - np.maximum.accumulate(np.where(starts, at, 0)) < n]

    order = first(k, group, ids)
    order = first(2 * k, group)
    return table.take(pa.array(np.sort(order)))


def _search(k: int, width: float, centres: dict[int, np.ndarray]):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(asked):
            rows = _few_copies(rows, k)
            dims = rows["dims"][0].as_py()
            ids, own = rows["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            raw = _matrix(rows["vector"].combine_chunks(), dims)
            queries = _matrix(asked["vector"].combine_chunks(), dims)
            packed = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            signs = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
            norm, fit = rows["norm"].to_numpy(), rows["fit"].to_numpy()
            scale = (norm / (fit * np.sqrt(dims))).astype(np.float32)
            slack = norm * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * width / np.sqrt(max(dims - 1, 1))
            # What single precision rounds away is added to the bound.
            slack = (slack + 1e-5 * (norm + np.linalg.norm(centres[dims]))).astype(np.float32)
            lengths = np.linalg.norm(queries, axis=1)
            # Queries at unit length, so that single precision cannot overflow.
            unit = queries / lengths[:, None]
            shift = (unit @ centres[dims]).astype(np.float32)
            turned = (unit @ rotation(dims).T).astype(np.float32)
            first = min(len(ids), 3 * k)
            for at in range(0, len(own), PART):
                part = slice(at, at + PART)
                guess = turned[part] @ signs.T
                guess *= scale
                guess += shift[part][:, None]
                guess[own[part][:, None] == ids] = -np.inf
                likely = np.argpartition(guess, len(ids) - first, axis=1)[:, len(ids) - first :]
                guess += slack
                for j in range(len(guess)):
                    # The best by estimate give a threshold; whatever may reach it is computed.
                    some = likely[j][guess[j, likely[j]] > -np.inf]
                    if len(some) >= k:
                        exact = np.sort(raw[some] @ unit[at + j])[-k]
                        some = np.flatnonzero(guess[j] >= exact - 1e-9 * abs(exact))
                    rough = raw[some] @ unit[at + j]
                    if len(some) > k:
                        limit = np.partition(rough, len(some) - k)[len(some) - k]
                        some = some[rough >= limit - 1e-9 * np.abs(rough).max()]
                    # One product after another, so that equal vectors have equal scores everywhere.
                    scores = (raw[some] * queries[at + j]).cumsum(axis=1)[:, -1] if len(some) else np.zeros(0)
                    best = np.lexsort((ids[some], -scores))[:k]
                    out.append((np.full(len(best), own[at + j]), ids[some][best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 3
        return pa.table(
            {
                "query_id": pa.array(columns[0].astype(np.int64)),
                "vec_id": pa.array(columns[1].astype(np.int64)),
                "score": pa.array(columns[2].astype(np.float64)),
            }
        )

    return run


def search(
    vectors: DataFrame, every: int = 20, k: int = K, width: float = WIDTH, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose id ``every`` divides."""
    rows = valid(vectors)
    centres = means(rows)
    if not centres:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coded = staged(index(rows, centres, block), "codes")
    asked = coded.filter(F.col("vec_id") % every == 0).select("vec_id", "vector", "dims").withColumn(
        "_n", F.xxhash64(F.monotonically_increasing_id())
    )
    # Groups are pairs of blocks: each side is repeated once per block of the other.
    rounds = {d: max(1, -(-n // (every * QUERY_BLOCK))) for d, (n, _) in centres.items()}
    per = lambda of: F.create_map(*[F.lit(x) for d in centres for x in (d, of[d])])[F.col("dims")]
    blocks = {d: -(-n // block) for d, (n, _) in centres.items()}
    left = coded.withColumn("part", F.explode(F.sequence(F.lit(0), per(rounds) - 1)))
    right = asked.select(
        "vec_id",
        "vector",
        "dims",
        F.pmod("_n", per(rounds)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), per(blocks) - 1)).alias("block"),
    )
    key = ["dims", "block", "part"]
    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInArrow(_search(k, width, {d: m for d, (_, m) in centres.items()}), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
