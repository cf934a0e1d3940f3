"""Near-duplicate classes by a similarity join of n-gram sets over prefix trees.

1. Every text becomes its set of hashed word n-grams. Equal sets are one node.
2. Document frequencies are counted over all texts; n-grams in ``COMMON`` texts or more are common. The global order of
   n-grams is: the others first, common ones last, by hash. Sets that reach the threshold share one of
   their first ``n - ceil(t n) + 1`` n-grams (the prefix), so only prefixes are brought together.
3. Per n-gram, sets whose sizes and places allow the threshold are candidates: each pair in short
   lists. In a long list each set is a candidate of one hub; once those links are known, pairs of the list that
   are not yet in one class are candidates too, so no link between classes is lost and copies are not expanded.
4. Of each set a bitmap is known, the parity of its n-grams per place: bits in which two differ are n-grams that only one of
   the sets has, at least one each. Pairs that have too many of them to reach the threshold go before any set moves.
5. The candidates of a set that are left are stored as a prefix tree in the global order: sorted, each with the length of
   the prefix it shares with the one before. The set walks the tree; overlaps of shared prefixes are
   counted once, and a subtree ends where what remains of either set cannot reach the overlap needed.
6. Classes are the connected components of the links.

Defined cases: null text and texts without words have the empty set and are linked with nothing; texts of
fewer than ``N`` words have their whole word sequence as their one n-gram; repeated rows have equal sets;
a null ``doc_id`` is in a class but never names one that has others; an empty table gives no rows. The integer
comparison ``100 * both >= percent * either`` decides, so ties at the threshold are links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyground.llm.chunks import slices
from skyground.llm.common import boxed, freed, shuffle_partitions, staged, unboxed
from skyground.llm.components import components

N = 5
PERCENT = 75
#: Texts from which on an n-gram is common.
COMMON = 16
#: Common n-grams sent to the executors, at most; where there are more, ``COMMON`` is doubled until they are few enough.
MOST_COMMON = 1 << 19
#: Sets in a list of which every pair is a candidate.
SHORT = 64
#: Sets of one n-gram brought together in a task; the list of a commoner n-gram is dealt out.
TOGETHER = 4096
#: Sets in one prefix tree, about.
TREE = 256
HOT = np.uint64(1 << 63)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = 64


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x >> np.uint64(1)


def gram_sets(texts: pa.Array, n: int = N) -> list[np.ndarray]:
    """Distinct n-grams of each text as sorted hashes of 63 bits."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    which = coded.indices.to_numpy()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    if "" in words:
        # Blanks at either end leave an empty word there.
        real = which != words.index("")
        which, owner = which[real], owner[real]
    value = hashes[which]
    sizes = np.bincount(owner, minlength=len(texts))
    rolled = np.zeros(max(len(value) - n + 1, 0), np.uint64)
    for i in range(n):
        rolled = rolled * FACTOR + value[i : i + len(rolled)]
    rolled = _mix(rolled)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= n:
            out.append(np.unique(rolled[at : at + size - n + 1]))
        elif size:
            # A sequence of its own length never equals one of n words.
            whole = np.array([size], np.uint64)
            for x in value[at : at + size]:
                whole = whole * FACTOR + x
            out.append(_mix(whole))
        else:
            out.append(np.zeros(0, np.uint64))
        at += size
    return out


def in_order(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """``grams`` in the global order: common ones carry the top bit."""
    if not len(common) or not len(grams):
        return grams
    short = grams >> np.uint64(23)
    at = np.minimum(np.searchsorted(common, short), len(common) - 1)
    return np.sort(np.where(common[at] == short, grams | HOT, grams))


def node_of(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def prefix(size: int, percent: int) -> int:
    """First n-grams of a set of which any set that reaches the threshold shares one with its own first."""
    return size - -(-percent * size // 100) + 1


def needed(a, b, percent: int):
    """Least overlap of sets of two sizes that reaches the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def parities(grams: np.ndarray) -> bytes:
    """Whether the n-grams at each place are odd in number; a bit or two for an n-gram, places by the lowest bits."""
    width = max(64, 1 << (len(grams) - 1).bit_length())
    return np.packbits(np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def most_shared(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """Upper bound of the overlap of two sets, by their sizes and :func:`parities`."""
    x, y = sorted((np.frombuffer(bits, np.uint8) for bits in (a, b)), key=len)
    while len(y) > len(x):
        # The halves together are the parities of half as many places.
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (size_a + size_b - int(np.bitwise_count(x ^ y).sum())) // 2


def nodes(docs: DataFrame, n: int = N) -> DataFrame:
    """``_row, doc_id, node, size, bits`` of each row of ``docs`` (``_row, doc_id, text``); no node for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(2)):
                sets = gram_sets(texts, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        batch.column(1).slice(at, len(texts)),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([parities(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["_row", "doc_id", "node", "size", "bits"],
                )

    return docs.select("_row", F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "_row long, doc_id long, node long, size long, bits binary"
    )


def _first_seen(texts: pa.Array, n: int, seen: set) -> list[np.ndarray]:
    """Sets that are not empty and that this task has not had before."""
    out = []
    for grams in gram_sets(texts, n):
        if len(grams) and (node := node_of(grams)) not in seen:
            seen.add(node)
            out.append(grams)
    return out


def common_grams(docs: DataFrame, n: int = N, least: int = COMMON, most: int = MOST_COMMON) -> np.ndarray:
    """The top 40 bits of the common n-grams, sorted; at most ``most``. Counted over all texts, equal
    sets of one task once."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    buckets = parts * 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in slices(batch.column(0), 32 << 20):
                sets = _first_seen(texts, n, seen)
                if not sets:
                    continue
                short, times = np.unique(np.concatenate(sets) >> np.uint64(23), return_counts=True)
                bucket = short % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                short, times, bucket = short[order], times[order], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                raw = short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if lo < hi]
                several = np.flatnonzero(times > 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([raw[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()),
                        # Only counts above 1 are written, with their places.
                        pa.array(
                            [
                                np.stack([s - lo, times[s]], 1).astype("<u4").tobytes()
                                for _, lo, hi in rows
                                for s in [several[slice(*np.searchsorted(several, [lo, hi]))]]
                            ],
                            pa.binary(),
                        ),
                    ],
                    names=["bucket", "grams", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        bucket = None

        def flush() -> pa.RecordBatch:
            grams = np.concatenate([h[0] for h in held])
            times = np.concatenate([h[1] for h in held])
            order = np.argsort(grams)
            grams, times = grams[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            total = np.add.reduceat(times, first)
            some = total >= least
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[first][some].astype(np.int64)), pa.array(total[some])], names=["gram", "times"]
            )

        for batch in batches:
            for b, raw, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and b != bucket:
                    yield flush()
                    held = []
                bucket = b
                grams = np.zeros((len(raw) // 5, 8), np.uint8)
                grams[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
                times = np.ones(len(grams), np.int64)
                where = np.frombuffer(counts, "<u4").reshape(-1, 2)
                times[where[:, 0]] = where[:, 1]
                held.append((grams.view("<u8").ravel(), times))
        if held:
            yield flush()

    counted = staged(
        docs.select("text")
        .mapInArrow(count, "bucket int, grams binary, counts binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(add, "gram long, times long"),
        "common",
    )
    per_power = counted.groupBy(F.floor(F.log2("times")).alias("power")).count().collect()
    total = sum(r["count"] for r in per_power)
    for r in sorted(per_power, key=lambda r: r["power"]):
        if total <= most:
            break
        total -= r["count"]
        least = 1 << (r["power"] + 1)
    found = counted.filter(F.col("times") >= least).select("gram").toArrow()
    return np.sort(found["gram"].to_numpy().astype(np.uint64))


def _lists(docs: DataFrame, common, n: int, percent: int, crowd: int) -> DataFrame:
    """Prefix n-grams of all sets, brought together by n-gram: ``kind`` 0 has candidate pairs, ``kind`` 1 the sets
    of long lists, with their list's hub."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    buckets = parts * 8
    row = np.dtype([("gram", "<u8"), ("node", "<i8"), ("size", "<u4"), ("at", "<u4")])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_common = common.value
        seen: set[int] = set()
        for batch in batches:
            for _, texts in slices(batch.column(0), 16 << 20):
                held = []
                for grams in _first_seen(texts, n, seen):
                    ordered = in_order(grams, grams_common)
                    p = prefix(len(grams), percent)
                    rows = np.empty(p, row)
                    rows["gram"], rows["node"] = ordered[:p], node_of(grams)
                    rows["size"], rows["at"] = len(grams), np.arange(p)
                    held.append(rows)
                if not held:
                    continue
                rows = np.concatenate(held)
                # Lists of common n-grams are long: they are dealt to ``TOGETHER`` lists at most by node.
                deal = np.where(rows["gram"] & HOT > 0, rows["node"].view(np.uint64) % np.uint64(crowd), np.uint64(0))
                bucket = (rows["gram"] + deal * FACTOR) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                rows, bucket = rows[order], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                some = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if lo < hi]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s[0] for s in some], pa.int32()),
                        pa.array([rows[lo:hi].tobytes() for _, lo, hi in some], pa.binary()),
                    ],
                    names=["bucket", "rows"],
                )

    def fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sizes and places of a shared n-gram leave room for the overlap needed."""
        sa, sb = a["size"].astype(np.int64), b["size"].astype(np.int64)
        room = 1 + np.minimum(sa - a["at"] - 1, sb - b["at"] - 1)
        return (a["node"] != b["node"]) & (100 * np.minimum(sa, sb) >= percent * np.maximum(sa, sb)) & (
            room >= needed(sa, sb, percent)
        )

    def meet(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(held), row)
        # Equal sets from several tasks are one.
        rows = rows[np.lexsort((rows["node"], rows["gram"]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows["gram"][1:] != rows["gram"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
        rows = rows[fresh]
        gram, length = np.unique(rows["gram"], return_counts=True)
        # A list that was dealt out is whole in no task; its pairs are found later.
        length[(gram & HOT > 0) & (crowd > 1)] = SHORT + 1
        per_row = np.repeat(length, np.unique(rows["gram"], return_counts=True)[1])
        rows, per_row = rows[per_row > 1], per_row[per_row > 1]
        short = rows[per_row <= SHORT]
        pairs = []
        for d in range(1, SHORT):
            a, b = short[:-d], short[d:]
            same = np.flatnonzero(a["gram"] == b["gram"]) if len(a) else []
            if not len(same):
                break
            a, b = a[same], b[same]
            ok = fits(a, b)
            pairs.append(np.stack([a["node"][ok], b["node"][ok]], 1))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.zeros(len(found), np.int32)),
                pa.array(np.zeros(len(found), np.int64)),
                pa.array(found[:, 0]),
                pa.array(found[:, 1]),
                pa.array(np.zeros(len(found), np.int64)),
                pa.array(np.zeros(len(found), np.int64)),
            ],
            names=["kind", "gram", "u", "v", "size", "at"],
        )
        long = rows[per_row > SHORT]
        if len(long):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(len(long), np.int32)),
                    pa.array(long["gram"].view(np.int64)),
                    pa.array(long["node"]),
                    pa.array(np.zeros(len(long), np.int64)),
                    pa.array(long["size"].astype(np.int64)),
                    pa.array(long["at"].astype(np.int64)),
                ],
                names=["kind", "gram", "u", "v", "size", "at"],
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        bucket = None
        for batch in batches:
            for b, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and b != bucket:
                    yield from meet(held)
                    held = []
                bucket = b
                held.append(raw)
        if held:
            yield from meet(held)

    return (
        docs.select("text")
        .mapInArrow(emit, "bucket int, rows binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(gather, "kind int, gram long, u long, v long, size long, at long")
    )


def walk(probe: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Which of ``members`` reach the threshold with ``probe``; all in the global order.

    Sorted members with the lengths of their shared prefixes are the prefix tree. ``count[k]`` is
    the overlap of ``probe`` with the first k n-grams of the path at hand, known up to ``known``.
    """
    order = sorted(range(len(members)), key=lambda i: members[i].astype(">u8").tobytes())
    links, before, count, known = [], np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
    for i in order:
        grams = members[i]
        m = min(len(before), len(grams))
        apart = np.flatnonzero(before[:m] != grams[:m])
        shared = min(int(apart[0]) if len(apart) else m, known)
        least = int(needed(len(probe), len(grams), percent))
        count = np.concatenate([count[: shared + 1], np.empty(len(grams) - shared, np.int64)])
        at = shared
        # What remains of the member, and of the probe behind the last n-gram passed.
        while True:
            passed = int(np.searchsorted(probe, grams[at - 1], side="right")) if at else 0
            if count[at] + min(len(grams) - at, len(probe) - passed) < least or at == len(grams):
                break
            to = min(len(grams), at + SEGMENT)
            part = grams[at:to]
            place = np.minimum(np.searchsorted(probe, part), len(probe) - 1)
            count[at + 1 : to + 1] = count[at] + np.cumsum(probe[place] == part)
            at = to
        before, known = grams, at
        if at == len(grams) and count[at] >= least:
            both = int(count[at])
            if 100 * both >= percent * (len(probe) + len(grams) - both):
                links.append(i)
    return links


def _possible(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose bitmaps leave room for the overlap needed."""
    marks = named.filter("node is not null").select("node", "size", "bits").dropDuplicates(["node"])
    mark = lambda end: marks.select(
        F.col("node").alias(end), F.col("size").alias(f"{end}_size"), F.col("bits").alias(f"{end}_bits")
    ).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes_and_bits = zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True)
            yield batch.select([0, 1]).filter(
                pa.array([most_shared(a, b, m, n) >= needed(m, n, percent) for m, n, a, b in sizes_and_bits], pa.bool_())
            )

    return (
        pairs.join(mark("u"), "u")
        .join(mark("v"), "v")
        .select("u", "v", "u_size", "v_size", "u_bits", "v_bits")
        .mapInArrow(run, "u long, v long")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` that reach the threshold. The candidates of a set with many are dealt to several
    trees, each of which gets the set as well."""
    degree = staged(pairs.groupBy("u").agg(F.ceil(F.count("*") / TREE).alias("parts")), "degree")
    dealt = staged(
        pairs.join(degree.hint("merge"), "u").select(
            "u", F.expr("pmod(hash(v), parts)").cast("int").alias("part"), "v"
        ),
        "dealt",
    )
    own = (
        dealt.select("u", "part")
        .distinct()
        .join(sets.select(F.col("node").alias("u"), "grams").hint("merge"), "u")
        .select("u", "part", F.lit(None).cast("long").alias("v"), "grams")
    )
    theirs = dealt.join(sets.select(F.col("node").alias("v"), "grams").hint("merge"), "v").select(
        "u", "part", "v", "grams"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probe, members, names = None, None, [], []

        def flush() -> pa.RecordBatch:
            found = walk(probe, members, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(found), pa.int64()), pa.array([names[i] for i in found], pa.int64())],
                names=["u", "v"],
            )

        for batch in batches:
            for u, part, v, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                grams = np.frombuffer(raw, "<u8")
                if v is None:
                    if members:
                        yield flush()
                    key, probe, members, names = (u, part), grams, [], []
                    continue
                members.append(grams)
                names.append(v)
        if members:
            yield flush()

    return (
        own.union(theirs)
        .repartition(shuffle_partitions(pairs.sparkSession), "u", "part")
        .sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
        .mapInArrow(run, "u long, v long")
    )


def _sets(docs: DataFrame, named: DataFrame, wanted: DataFrame, common, n: int) -> DataFrame:
    """``node, grams`` of the nodes in ``wanted``, from one document each."""
    one = named.join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.min("_row").alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                grams = [in_order(g, common.value).astype("<u8").tobytes() for g in gram_sets(texts, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(grams, pa.binary())], names=["node", "grams"]
                )

    return docs.join(one.hint("merge"), "_row").select("node", "text").mapInArrow(run, "node long, grams binary")


def _links(docs: DataFrame, named: DataFrame, pairs: DataFrame, common, n: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` that reach the threshold, written; their sets go again."""
    sets = staged(_sets(docs, named, _ends(pairs), common, n), "sets")
    links = staged(_verified(pairs, sets, percent), "links")
    freed(sets)
    return links


def classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``_row, doc_id, n_shingles, component_id, _class`` for each row of ``docs`` (``_row, doc_id, text``).

    ``_row`` must name a row of ``docs`` for good; rows that share it must share ``doc_id`` and text.
    """
    spark = docs.sparkSession
    named = staged(nodes(docs, n), "nodes")
    common = spark.sparkContext.broadcast(common_grams(docs, n))
    total = named.filter("node is not null").count()
    crowd = max(1, math.ceil(total / TOGETHER))
    lists = staged(_lists(docs, common, n, percent, crowd), "lists")
    crowded = lists.filter("kind = 1").select("gram", F.col("u").alias("node"), "size", "at")
    # Each set of a long list meets one hub of about its size. The set with the most n-grams in long lists is
    # the least changed of its kind, and so the likeliest to reach the others.
    class_of = F.floor(F.log("size") / math.log(100 / percent))
    weights = crowded.groupBy("node").agg(F.count("*").alias("weight"))
    hubs = (
        crowded.join(weights.hint("merge"), "node")
        .groupBy("gram", class_of.alias("c"))
        .agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    )
    stars = (
        crowded.withColumn("c", F.explode(F.array(class_of, class_of - 1)))
        .join(hubs.hint("merge"), ["gram", "c"])
        .select(F.col("hub").alias("u"), F.col("node").alias("v"))
    )
    pairs = staged(_distinct(lists.filter("kind = 0").select("u", "v").union(stars)), "pairs")
    likely = staged(_possible(pairs, named, percent), "likely")
    links = _links(docs, named, likely, common, n, percent)
    # What the stars left open in long lists: pairs of sets in different classes.
    labels = staged(components(links), "labels")
    labelled = crowded.join(labels.hint("merge"), "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    open_ = (
        labelled.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    )
    left = staged(labelled.join(open_.select("gram").hint("merge"), "gram", "left_semi"), "open")
    a, b = left.alias("a"), left.alias("b")
    room = 1 + F.least(F.expr("a.size - a.at - 1"), F.expr("b.size - b.at - 1"))
    rest = a.join(b.hint("merge"), F.expr("a.gram = b.gram and a.label < b.label")).filter(
        (100 * F.least("a.size", "b.size") >= percent * F.greatest("a.size", "b.size"))
        & (room * (100 + percent) >= percent * (F.col("a.size") + F.col("b.size")))
    )
    rest = _distinct(rest.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")))
    rest = rest.join(pairs.hint("merge"), ["u", "v"], "left_anti")
    rest = staged(_possible(rest, named, percent), "rest")
    if not rest.isEmpty():
        links = links.union(_links(docs, named, rest, common, n, percent))
        labels = staged(components(links), "labels")
    joined = staged(
        named.drop("bits").join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node")),
        "joined",
    )
    freed(named, lists, pairs, likely, left, rest)
    least = staged(joined.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")), "least")
    return joined.join(least.hint("merge"), "label", "left").select(
        "_row",
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
        # Rows with the empty set are classes of their own, named by themselves.
        F.when(F.col("label").isNotNull(), F.struct(F.col("label").alias("id"), F.lit(False).alias("empty")))
        .otherwise(F.struct(F.col("_row").alias("id"), F.lit(True).alias("empty")))
        .alias("_class"),
    )


def _distinct(pairs: DataFrame) -> DataFrame:
    return (
        pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a hash of id and text: rows that share it are equal in both."""
    return docs.withColumn("_row", F.xxhash64("doc_id", "text"))


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``."""
    return classes(numbered(docs.select("doc_id", "text")), n, percent).drop("_row", "_class")


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each class, with its columns: the one with the smallest id (null last); of several
    with that id the one with the smallest hash, and one of rows that repeat it."""
    rows = numbered(docs.select("doc_id", "text", boxed(docs.columns)))
    found = classes(rows.select("_row", "doc_id", "text"), n, percent)
    first = found.groupBy("_class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_row")).alias("k"))
    kept = rows.join(first.select("k._row").hint("merge"), "_row", "left_semi")
    return kept.dropDuplicates(["_row"]).select(*unboxed(docs.columns))
