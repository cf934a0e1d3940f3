"""Remove byte strings of a given length that start more than once, by a difference-cover suffix order.

1. Sampling. Of every window of ``length`` bytes the smallest fingerprint of its 32-byte strings is the anchor.
   Equal windows have equal anchors, so a window whose anchor occurs once in the corpus starts once.
   Consecutive windows with one anchor make an interval; there is one for about 190 bytes.
2. Intervals whose anchors occur again are grouped by anchor and fingerprint of all their bytes. Where a group
   has two members, all their windows are repeated (fingerprints alone decide that), and one member goes on for all.
3. The bytes of those that go on are brought together by anchor, so that equal windows meet in one task, and their
   suffixes are ordered there by difference cover modulo 3: positions 1 and 2 modulo 3 are named
   by sorting triples of 8-byte symbols, then triples of names, until names span the window; every window
   is a few bytes followed by a named position, chosen so that any two windows agree in the choice. Windows
   are sorted by that, and equal neighbours start the same string. Names are ranks of real bytes, so no
   fingerprint decides here.
4. An anchor with very many different intervals, or very many bytes of them, is a group that no task should hold: a
   common line amid different texts makes one. Equal windows hold the anchor at one offset, so its windows are
   halved by that offset: all windows of a half have some 200 bytes around the anchor in common, and an interval meets only
   those that agree there. What meets none is done, equal stretches are settled as in step 2, small groups are ordered as in
   step 3, and what is still crowded is halved again, with more bytes in common, until a half is one offset
   and its bytes are the window. A level is two rows for an interval of the last one, and plain aggregations.

Documents of which nothing repeats never move after sampling. A suffix array over all bytes would carry every position
through several sorts; sampling leaves out only positions that cannot repeat.

Defined cases: null text is the empty text; texts shorter than ``length`` keep all bytes; rows that repeat
``doc_id`` and text repeat each other's strings, so both lose them; an empty table gives no rows. Results are per row;
columns of the documents other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyground.llm.common import freed, shuffle_partitions, staged

LENGTH = 400
GRAM = 32
#: Windows of one document looked at together.
STRETCH = 1 << 18
#: Bytes ordered together; ranks of positions then fit 21 bits, three of them one sort key.
ORDERED = 1 << 21
#: Different intervals of one anchor beyond which its windows are halved by offset.
CROWD = 1024
BASE = 0x9E3779B97F4A7C15
INTERVALS = "_a long, _b int, s long, n int, anchor long, print long, twice boolean"


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self, n: int):
        base, back = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
        self.up, self.down = (
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (base, back)
        )


def anchors(data: np.ndarray, length: int, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each 32-byte string, and for each window the smallest of its own."""
    n, width = len(data), length - GRAM + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.down[:n], out=sums[1:])
    prints = (sums[GRAM:] - sums[:-GRAM]) * powers.up[: n - GRAM + 1]
    prints ^= prints >> np.uint64(32)
    prints *= np.uint64(0xFF51AFD7ED558CCD)
    prints ^= prints >> np.uint64(29)
    # Running minimum: within rows of one width, from either end.
    m = len(prints)
    rows = np.full((-(-m // width), width), np.uint64(2**64 - 1))
    rows.ravel()[:m] = prints
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return prints, np.minimum(after[: m - width + 1], before[width - 1 : m])


def sample(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per interval; ``twice`` where the anchor stands in it more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(STRETCH + length)
        for batch in batches:
            for i in range(len(batch)):
                raw = batch.column(2)[i].as_buffer()
                if raw is None or raw.size < length:
                    continue
                data = np.frombuffer(raw, np.uint8)
                for at in range(0, len(data) - length + 1, STRETCH):
                    part = data[at : at + STRETCH + length - 1]
                    prints, least = anchors(part, length, powers)
                    cuts = np.flatnonzero(np.diff(least)) + 1
                    starts = np.concatenate([[0], cuts])
                    ends = np.concatenate([cuts, [len(least)]])
                    whole = memoryview(part)
                    bounds = list(zip(starts.tolist(), ends.tolist(), strict=True))
                    body = [xxhash.xxh3_64_intdigest(whole[s : e + length - 1]) for s, e in bounds]
                    width = length - GRAM
                    twice = [
                        bool(np.count_nonzero(prints[s : e + width] == least[s]) > 1) for s, e in bounds
                    ]
                    k = len(bounds)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(batch.column(0)[i], k),
                            pa.repeat(batch.column(1)[i], k),
                            pa.array(starts + at),
                            pa.array((ends - starts).astype(np.int32)),
                            pa.array(least[starts].view(np.int64)),
                            pa.array(np.array(body, np.uint64).view(np.int64)),
                            pa.array(twice),
                        ],
                        names=["_a", "_b", "s", "n", "anchor", "print", "twice"],
                    )

    return docs.select("_a", "_b", "_bytes").mapInArrow(run, INTERVALS)


def _ranks(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.uint64)


def _triple(names: np.ndarray, at: np.ndarray, second: int, third: int) -> np.ndarray:
    """Names of the positions ``at`` by the triples of names there and two steps on."""
    a, b, c = (names[np.minimum(at + step, len(names) - 1)] for step in (0, second, third))
    bits = np.uint64(max(1, int(names.max()).bit_length()))
    if int(bits) <= 21:
        return _ranks((a << bits | b) << bits | c)
    return _ranks(_ranks(a << np.uint64(32) | b) << np.uint64(32) | c)


def starts_again(text: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For each of ``windows`` (starts in ``text``), whether its ``length`` bytes also start at another of them.

    ``text`` may end after its last window.
    """
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    symbol = np.zeros(len(text), np.uint64)
    for i in range(8):
        symbol = symbol << np.uint64(8) | padded[i : len(text) + i]
    # Only positions that some window reaches at the level's steps are named; positions 1 and 2 modulo 3.
    cover = np.arange(len(text))
    cover = cover[cover % 3 != 0]
    names, span = _ranks(symbol), 8
    while span * 3 <= length - 2:
        named = np.zeros(len(text), np.uint64)
        named[cover] = _triple(names, cover, span, 2 * span)
        names, span = named, span * 3
    # A last triple, whose names overlap, spans all but 2 to 4 bytes of a window.
    step = (length - 2 - span) // 3 * 3
    rest = length - step - span
    final = np.zeros(len(text) + 2, np.uint64)
    final[cover] = _triple(names, cover, min(step, span), step)

    def bytes_at(p: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(p), np.uint64)
        for i in range(n):
            out = out << np.uint64(8) | padded[p + i]
        return out

    found = np.zeros(len(windows), bool)
    residue = windows % 3
    # Merge: windows of any two residues agree in one of these to put 0, 1 or 2 bytes before the name.
    for lead, mine in ((0, residue != 0), (1, residue != 2), (2, residue != 1)):
        at = windows[mine]
        key = final[at + lead] << np.uint64(8 * rest)
        key |= bytes_at(at, lead) << np.uint64(8 * (rest - lead)) | bytes_at(at + lead + span + step, rest - lead)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        found[np.flatnonzero(mine)[again]] = True
    return found


def _order(length: int):
    """Runs of repeated windows of intervals that come sorted by anchor."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        sizes = np.array([len(r[4]) for r in rows])
        base = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        windows = np.repeat(base - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        again = starts_again(text, windows, length)
        ends = np.cumsum(counts)
        out: list[tuple] = []
        for (_, a, b, s, _), lo, hi in zip(rows, (ends - counts).tolist(), ends.tolist(), strict=True):
            flags = np.concatenate([[False], again[lo:hi], [False]])
            edges = np.flatnonzero(flags[1:] != flags[:-1])
            out += [(a, b, s + x, s + y) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
            names=["_a", "_b", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_bytes, group_start, group_bytes = 0, 0, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[0] != held[-1][0]:
                    group_start, group_bytes = len(held), held_bytes
                held.append(row)
                held_bytes += len(row[4])
                # Whole groups go together; what belongs to the group at hand waits.
                if held_bytes > ORDERED and group_start:
                    yield flush(held[:group_start])
                    held, held_bytes, group_start = held[group_start:], held_bytes - group_bytes, 0
        if held:
            yield flush(held)

    return run


PIECES = "grp binary, print binary, _a long, _b int, s long, lo int, hi int, at int, part binary"
PIECE_TYPES = (
    pa.binary(),
    pa.binary(),
    pa.int64(),
    pa.int32(),
    pa.int64(),
    pa.int32(),
    pa.int32(),
    pa.int32(),
    pa.binary(),
)
PIECE_NAMES = [field.split()[0] for field in PIECES.split(", ")]


def _halved(a: int, b: int, s: int, lo: int, hi: int, at: int, part: bytes, length: int) -> Iterator[tuple]:
    """The one or two pieces of a piece: its windows whose anchor stands at the lower and the upper offsets of ``lo..hi``.

    ``part`` starts at ``s`` and holds the piece's windows, the anchor at ``at`` in it.
    """
    middle = (lo + hi) // 2
    least = at - (len(part) - length)
    for low, high in ((lo, middle), (middle + 1, hi)):
        first, last = max(low, least), min(high, at)
        if first > last:
            continue
        bytes_ = part[at - last : at - first + length]
        # What every window with the anchor at low..high has, whichever of them the piece has.
        shared = bytes_[last - low : last - high + length]
        yield (
            xxhash.xxh3_128_digest(struct.pack("<ii", low, high) + shared),
            xxhash.xxh3_128_digest(struct.pack("<ii", first, last) + bytes_),
            a,
            b,
            s + at - last,
            low,
            high,
            last,
            bytes_,
        )


def _pieces(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of pieces, about ``ORDERED`` bytes each."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 100
        if size > ORDERED:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), PIECE_TYPES, strict=True)], names=PIECE_NAMES
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), PIECE_TYPES, strict=True)], names=PIECE_NAMES
        )


def _split_intervals(length: int):
    """Pieces of intervals, by the first place of the anchor in each window."""

    def rows(batches: Iterator[pa.RecordBatch], powers: _Powers) -> Iterator[tuple]:
        for batch in batches:
            for i in range(len(batch)):
                anchor, a, b, s, part = (c[i].as_py() for c in batch.columns)
                prints, _ = anchors(np.frombuffer(part, np.uint8), length, powers)
                places = np.flatnonzero(prints.view(np.int64) == anchor)
                windows = len(part) - length + 1
                edges = [0, *(places[places < windows - 1] + 1).tolist(), windows]
                for start, end, place in zip(edges, edges[1:], places.tolist(), strict=False):
                    piece = part[start : end + length - 1]
                    yield from _halved(a, b, s + start, 0, length - GRAM, place - start, piece, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pieces(rows(batches, _Powers(STRETCH + length)))

    return run


def _split_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pieces(
            piece
            for batch in batches
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)
            for piece in _halved(*row, length)
        )

    return run


def _ordered(parts: DataFrame, key: str, length: int) -> DataFrame:
    """Runs of repeated windows among ``parts`` that agree in ``key``, whose groups are bounded."""
    return (
        parts.select(key, "_a", "_b", "s", "part")
        .repartition(shuffle_partitions(parts.sparkSession) * 2, key)
        .sortWithinPartitions(key)
        .mapInArrow(_order(length), "_a long, _b int, lo long, hi long")
    )


def crowded_repeats(intervals: DataFrame, length: int) -> list[DataFrame]:
    """Runs of repeated windows of intervals whose anchors are crowded: ``anchor, _a, _b, s, part``."""
    pieces = intervals.mapInArrow(_split_intervals(length), PIECES)
    found: list[DataFrame] = []
    while True:
        pieces = staged(pieces, "pieces")
        same = pieces.groupBy("grp", "print").agg(
            F.count("*").alias("copies"), F.min(F.struct("_a", "_b", "s")).alias("one"), F.max(F.length("part")).alias("n")
        )
        same = staged(same, "same")
        again = same.filter("copies > 1").select("grp", "print", "n").hint("merge")
        again = pieces.select("grp", "print", "_a", "_b", "s").join(again, ["grp", "print"])
        found.append(again.select("_a", "_b", F.col("s").alias("lo"), (F.col("s") + F.col("n") - length + 1).alias("hi")))
        groups = same.groupBy("grp").agg(F.count("*").alias("members"), F.sum("n").alias("size")).filter("members > 1")
        crowded = (F.col("members") > CROWD) | (F.col("size") > ORDERED)
        alive = same.join(groups.hint("merge"), "grp").select("grp", "one._a", "one._b", "one.s", crowded.alias("crowded"))
        # One member of each kind goes on; the bytes of a level move once.
        alive = staged(pieces.drop("print").join(alive.hint("merge"), ["grp", "_a", "_b", "s"]), "alive")
        found.append(_ordered(alive.filter("not crowded"), "grp", length))
        many = alive.filter("crowded")
        if many.isEmpty():
            return found
        # A piece of one offset has all its bytes in its group, so that no group of such has two members.
        pieces = many.select("_a", "_b", "s", "lo", "hi", "at", "part").mapInArrow(_split_pieces(length), PIECES)


def repeats(keyed: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Runs ``[lo, hi)`` of starts of repeated windows per document key, and the documents that have candidates.

    ``keyed`` has ``_a, _b, _bytes``.
    """
    spark = keyed.sparkSession
    intervals = staged(sample(keyed, length), "intervals")
    again = (
        intervals.groupBy("anchor")
        .agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("times"))
        .filter("times > 1")
        .select("anchor")
    )
    # Merge joins throughout: either side grows with the documents. Both are plain shuffles, so hot anchors are split.
    again = staged(again, "again")
    candidates = staged(intervals.join(again.hint("merge"), "anchor", "left_semi"), "candidates")
    freed(intervals, again)
    groups = staged(
        candidates.groupBy("anchor", "print").agg(
            F.count("*").alias("copies"),
            F.min(F.struct("_a", "_b", "s", "n")).alias("one"),
            F.max("twice").alias("twice"),
        ),
        "groups",
    )
    whole = candidates.join(groups.filter("copies > 1").select("anchor", "print").hint("merge"), ["anchor", "print"])
    whole = whole.select("_a", "_b", F.col("s").alias("lo"), (F.col("s") + F.col("n")).alias("hi"))
    crowd = groups.groupBy("anchor").agg(
        F.count("*").alias("crowd"), F.max("twice").alias("any"), F.sum(F.col("one.n") + length - 1).alias("size")
    )
    crowd = staged(
        crowd.filter("crowd > 1 or any").select(
            "anchor", ((F.col("crowd") > CROWD) | (F.col("size") > ORDERED)).alias("crowded")
        ),
        "crowd",
    )
    wanted = (
        groups.join(crowd.hint("merge"), "anchor")
        .groupBy("one._a", "one._b")
        .agg(F.collect_list(F.struct("one.s", "one.n", "anchor", "crowded")).alias("wanted"))
    )
    # Bytes move once for both: the documents to cut, and their intervals to look at.
    about = candidates.select("_a", "_b").distinct().join(wanted.hint("merge"), ["_a", "_b"], "left")
    touched = staged(keyed.join(about.hint("merge"), ["_a", "_b"]), "touched")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes of the wanted intervals."""
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        names = ["anchor", "_a", "_b", "s", "crowded", "part"]
        for batch in batches:
            out: list[tuple] = []
            for a, b, raw, wanted in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for w in wanted:
                    part = raw[w["s"] : w["s"] + w["n"] + length - 1]
                    out.append((w["anchor"], a, b, w["s"], w["crowded"], part))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names
                )

    parts = touched.filter("wanted is not null").select("_a", "_b", "_bytes", "wanted")
    parts = parts.mapInArrow(take, "anchor long, _a long, _b int, s long, crowded boolean, part binary")
    some = not crowd.filter("crowded").isEmpty()
    if some:
        # Read twice below.
        parts = staged(parts, "parts")
    found = [whole, _ordered(parts.filter("not crowded"), "anchor", length)]
    if some:
        found += crowded_repeats(parts.filter("crowded").select("anchor", "_a", "_b", "s", "part"), length)
    return reduce(DataFrame.union, found), touched


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with its content key and its text as bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("_a"),
        F.hash(text, "doc_id").alias("_b"),
        text.cast("binary").alias("_bytes"),
    )


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``_a, _b, spans, kept`` (removed byte spans, bytes that stay) of each different document that loses some."""
    keys = keyed(docs).select("_a", "_b", "_bytes")
    runs, touched = repeats(keys, length)
    # The runs of a document are fewer than its bytes.
    spans = runs.groupBy("_a", "_b").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, raw, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                joined: list[list[int]] = []
                for lo, hi in sorted((r["lo"], r["hi"] + length - 1) for r in found):
                    if joined and lo <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], hi)
                    else:
                        joined.append([lo, hi])
                edges = [0, *[x for span in joined for x in span], len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append((a, b, joined, kept))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int64())), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["_a", "_b", "spans", "kept"],
                )

    return (
        touched.join(spans.hint("merge"), ["_a", "_b"])
        .select("_a", "_b", "_bytes", "runs")
        .mapInArrow(cut, "_a long, _b int, spans array<array<long>>, kept binary")
    )


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    # Only figures go back to all rows, one set per different document.
    lost = staged(
        cleaned(docs, length).select(
            "_a",
            "_b",
            F.length("kept").cast("long").alias("left"),
            F.size("spans").cast("long").alias("spans"),
            F.sha2("kept", 256).alias("sha"),
        ),
        "lost",
    ).dropDuplicates(["_a", "_b"])
    rows = keyed(docs).select(
        "_a", "_b", "doc_id", F.length("_bytes").cast("long").alias("n_bytes"), F.sha2("_bytes", 256).alias("all")
    )
    return rows.join(lost.hint("merge"), ["_a", "_b"], "left").select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.coalesce("left", "n_bytes")).alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "all").alias("kept_sha256"),
    )


