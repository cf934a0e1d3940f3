"""Bulk-synchronous best-fit packing of token sequences.

Every document is tokenized once; what is kept of it are pieces of at most ``capacity`` tokens. Pieces are
ranked by length: each task numbers its pieces per length, and sums over tasks give every piece
its rank among the pieces of its length, without bringing them together. Since a length is a small
integer, all pieces of one length and all open sequences with one gap move as one: a round
takes the longest lengths left, sweeps to the successor gap (the smallest that is long enough), gives
the n-th sequence with that gap to the n-th piece by rank, moves those sequences to what remains
of their gap, and goes on with the pieces that found none. The sweeps see counts of lengths and gaps,
at most ``capacity`` each whatever the input; what they give is a list of ranges (length, ranks,
sequences, offset), by which every piece finds its place on the executors.

Defined cases: null text is the empty text and gives the end token alone; equal lengths are ordered by
task and place in it, repeated rows are packed each; an empty table gives no pieces. Only ``doc_id`` and ``text``
are read, other columns are not carried. Full pieces need no partner and get a sequence each.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyground.llm.chunks import slices
from skyground.llm.common import staged
from skyground.llm.word_bpe import word_bpe

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document, numbered per task and length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = word_bpe(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                ids, bounds = bpe.encode(texts)
                sizes = np.diff(bounds) + 1
                counts = -(-sizes // capacity)
                which = np.repeat(np.arange(len(sizes)), counts)
                number = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = number * capacity
                length = np.minimum(sizes[which] - start, capacity)
                first = bounds[:-1][which] + start
                # The end token stands behind the document's last id.
                last = start + length == sizes[which]
                crc = np.fromiter(
                    (
                        zlib.crc32(end if z else b"", zlib.crc32(ids[a : a + n - z]))
                        for a, n, z in zip(first.tolist(), length.tolist(), last.tolist(), strict=True)
                    ),
                    np.int64,
                    len(which),
                )
                order = np.argsort(length, kind="stable")
                sorted_lengths = length[order]
                run = np.arange(len(order)) - np.searchsorted(sorted_lengths, sorted_lengths)
                nth = np.empty(len(order), np.int64)
                nth[order] = seen[sorted_lengths] + run
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)).take(pa.array(which)),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc),
                        pa.array(np.full(len(which), task, np.int32)),
                        pa.array(nth),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Places for ``counts[length]`` pieces of each length: rows (length, rank, sequence, offset), each
    holding up to the next row of its length; and the number of sequences.

    All sequences with one gap are ranges of numbers, so a round costs a few ranges however many
    pieces it places.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    open_gaps = 0  # bit g: some sequence has gap g
    rows, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fits = open_gaps >> length
            if not fits:
                # Open as many as this length alone needs, so that every round serves all of them.
                number = -(-left // (capacity // length))
                gaps[capacity].append((made, number))
                made += number
                open_gaps |= 1 << capacity
                continue
            gap = length + (fits & -fits).bit_length() - 1
            first, number = gaps[gap].pop()
            take = min(left, number)
            rows.append((length, rank, first, capacity - gap))
            if take < number:
                gaps[gap].append((first + take, number - take))
            if not gaps[gap]:
                open_gaps &= ~(1 << gap)
            if gap > length:
                gaps[gap - length].append((first, take))
                open_gaps |= 1 << (gap - length)
            left, rank = left - take, rank + take
    return np.array(rows, np.int64).reshape(-1, 4), made


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    pieces = staged(cut(docs, tokenizer, capacity, end_id), "pieces")
    per_task = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    # At most one row per possible length reaches the driver.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = sweep(counts, capacity)
    # Tasks per length, not pieces, stand in these windows.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(
        "task", "length", "before"
    )
    keys = plan[:, 0] * (1 << 48) + plan[:, 1]
    plan = plan[order := np.argsort(keys)]
    keys = keys[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            length, rank = col["length"].to_numpy(), col["nth"].to_numpy() + col["before"].to_numpy()
            row = np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[col[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")],
                    pa.array(plan[row, 2] + rank - plan[row, 1]),
                    pa.array(plan[row, 3]),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # By shuffle: there are as many offsets as tasks times lengths.
    return pieces.join(offsets.hint("merge"), ["task", "length"]).mapInArrow(place, PLACED)
