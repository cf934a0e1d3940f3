"""Encode columns of texts chunk by chunk.

A text is cut where no token can cross. Arrow gives each distinct chunk of a slice of texts a number, a chunk is
encoded when a worker first meets it, and token ids of whole texts are gathered by number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Bytes of chunks and ids a worker remembers, half of them the most recent ones.
REMEMBERED_BYTES = 64 << 20
#: What a chunk and its ids cost in objects and table entries, beside their own bytes.
ENTRY_BYTES = 400


class ChunkCache:
    """Ids of chunks as little-endian bytes; ``encode`` gets the chunks not met so far.

    Bounded by bytes in two generations: when the young one has its half, it becomes the old one and what was old
    goes, so that chunks in use stay. What a single call asks for is not bounded by it; slices of texts bound that.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED_BYTES):
        self.encode, self.half = encode, remembered // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _keep(self, chunk: str, blob: bytes) -> None:
        cost = ENTRY_BYTES + len(chunk) + len(blob)
        if cost > self.half:
            return
        if self.size + cost > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[chunk] = blob
        self.size += cost

    def ids(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        new: dict[str, None] = {}
        for chunk in chunks:
            blob = self.young.get(chunk)
            if blob is None:
                blob = self.old.get(chunk)
                if blob is None:
                    new[chunk] = None
                else:
                    self._keep(chunk, blob)
            out.append(blob)
        if new:
            names = list(new)
            made = dict(zip(names, self.encode(names), strict=True))
            for chunk, blob in made.items():
                self._keep(chunk, blob)
            out = [made[c] if blob is None else blob for c, blob in zip(chunks, out, strict=True)]
        return out


def encode_lists(lists: pa.ListArray, cache: ChunkCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all lists of chunks end to end, and where each list's ids start (one more than lists)."""
    coded = lists.flatten().dictionary_encode()
    blobs = cache.ids(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    pool = np.frombuffer(b"".join(blobs), "<u4")
    starts = np.cumsum(sizes) - sizes
    which = coded.indices.to_numpy()
    each = sizes[which]
    ends = np.concatenate([[0], np.cumsum(each)])
    places = np.repeat(starts[which] - ends[:-1], each) + np.arange(ends[-1])
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return pool[places], ends[bounds]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of ``texts`` of about ``most`` bytes, a longer text alone, each with the place of its first."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, texts.slice(at, to - at)
        at = to
