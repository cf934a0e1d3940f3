"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read as its protobuf and rebuilt: normaliser, metaspace marker, unigram scores or BPE merges,
byte fallback. A text's ids are gathered from the ids of its chunks: words, each with the markers before it. That holds
for models no piece of which has a marker behind another character, and for which cutting is
checked when a model is loaded; other models encode whole texts. Each new chunk is
encoded by the rebuilt tokenizer, in batches and multithreaded where the process has threads. Parity is verified
against the sentencepiece library on each; where they differ the library's ids are taken and the text is
marked, so that ids always agree with it.

Defined cases: null text gives null ids; the empty text gives no ids; repeated rows are encoded alike; an empty table
gives no rows. Decoding skips control pieces; bytes that are no UTF-8 become U+FFFD; ids outside the
vocabulary are an error. Columns of the documents beyond those asked for are carried unless a result
column has their name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Regex, Tokenizer, models, normalizers

from skyground.llm.chunks import ChunkCache, encode_lists, slices
from skyground.llm.common import free_name, others

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
RESULTS = ("ids", "parity")
#: Chunks without parity a worker remembers.
MOST_ODD = 50_000


def read_model(path: str) -> pb.ModelProto:
    with open(path, "rb") as file:
        return pb.ModelProto.FromString(file.read())


def _merges(proto: pb.ModelProto) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, the best pieces first."""
    place = {p.piece: i for i, p in enumerate(proto.pieces) if p.type != CONTROL}
    found = []
    for i, p in enumerate(proto.pieces):
        if p.type != NORMAL:
            continue
        for cut in range(1, len(p.piece)):
            left, right = p.piece[:cut], p.piece[cut:]
            if left in place and right in place:
                found.append((-p.score, i, place[left], place[right], left, right))
    found.sort(key=lambda x: x[:4])
    return [(x[4], x[5]) for x in found]


def rebuild(proto: pb.ModelProto) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library; the marker before a text is the caller's."""
    kind = proto.trainer_spec.model_type
    fallback = proto.trainer_spec.byte_fallback
    if kind == BPE:
        model = models.BPE(
            {p.piece: i for i, p in enumerate(proto.pieces)},
            _merges(proto),
            unk_token=next(p.piece for p in proto.pieces if p.type == UNKNOWN),
            fuse_unk=True,
            byte_fallback=fallback,
        )
    elif kind == UNIGRAM:
        unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        model = models.Unigram([(p.piece, p.score) for p in proto.pieces], unknown, fallback)
    else:
        raise ValueError(f"no rebuild for model type {kind}")
    steps = []
    if proto.normalizer_spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(proto.normalizer_spec.precompiled_charsmap))
    if proto.normalizer_spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(model)
    tokenizer.normalizer = normalizers.Sequence(steps)
    return tokenizer


class PieceCodec:
    """Encodes and decodes lists of texts; one per worker process and file."""

    def __init__(self, path: str):
        self.proto = read_model(path)
        self.rebuilt = rebuild(self.proto)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.proto.SerializeToString())
        spec = self.proto.normalizer_spec
        # Words can be cut apart if a marker only ever begins a piece and nothing but blanks is normalised.
        self.cuts = (
            spec.add_dummy_prefix
            and not spec.precompiled_charsmap
            and not spec.remove_extra_whitespaces
            and not any(MARK in p.piece.lstrip(MARK) for p in self.proto.pieces)
        )
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.cache = ChunkCache(self._encode)
        self.odd: set[str] = set()
        self.bytes = [
            bytes([int(p.piece[3:-1], 16)])
            if p.type == BYTE
            else b""
            if p.type == CONTROL
            else " ⁇ ".encode()
            if p.type == UNKNOWN
            else p.piece.replace(MARK, " ").encode()
            for p in self.proto.pieces
        ]

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, which are written without their first marker; parity with the library is verified on each."""
        mine = self.rebuilt.encode_batch([self.prefix + c for c in chunks], add_special_tokens=False)
        theirs = self.library.encode(chunks, num_threads=1)
        if self.cuts and "" in chunks:
            # The empty chunk is a marker with nothing behind it, not the empty text.
            theirs[chunks.index("")] = self.library.encode("\n ")[len(self.library.encode("\n")) :]
        out = []
        for chunk, a, b in zip(chunks, mine, theirs, strict=True):
            ids = a.ids
            if ids != b:
                self.odd.add(chunk)
                ids = b
            out.append(np.array(ids, "<u4").tobytes())
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, where each text's start, and which texts the rebuilt tokenizer
        encodes as the library does; null is empty."""
        texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
        if self.cuts:
            # Runs of blanks belong to the word behind them; texts that have some are cut by hand.
            runs = pc.match_substring_regex(texts, "^ |  | $|^$").to_numpy(zero_copy_only=False)
            lists = pc.split_pattern(texts, " ")
            if runs.any():
                cut = lists.to_pylist()
                for i in np.flatnonzero(runs).tolist():
                    cut[i] = _words(cut[i])
                lists = pa.array(cut, pa.list_(pa.string()))
        else:
            lists = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), texts)
        if len(self.odd) > MOST_ODD:
            # Found again as their chunks are: the cache goes with them.
            self.odd, self.cache = set(), ChunkCache(self._encode)
        ids, bounds = encode_lists(lists, self.cache)
        same = np.ones(len(texts), bool)
        if self.odd:
            strange = pc.is_in(lists.flatten(), pa.array(sorted(self.odd))).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(strange)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            same = np.diff(ends) == 0
        return ids, bounds, same

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the marker the encoder set before it."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        if self.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _words(parts: list[str]) -> list[str]:
    """What stands between single blanks, with empty parts put before the next word as its blanks."""
    out, blanks = [], 0
    for part in parts:
        if part:
            out.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    # Blanks at the end are a chunk of their own; the empty text has none.
    if blanks and len(parts) > 1:
        out.append(" " * (blanks - 1))
    return out


@lru_cache(2)
def piece_codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``ids`` and ``parity`` (the rebuilt tokenizer gives the library's ids)."""
    carried = others(docs, RESULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            for at, texts in slices(batch.column(len(carried))):
                ids, bounds, same = codec.encode(texts)
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)),
                    pa.array(ids.astype(np.int32)),
                    mask=texts.is_null(),
                )
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(at, len(texts)) for c in batch.columns[:-1]], lists, pa.array(same)],
                    names=[*carried, *RESULTS],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in carried)
    return docs.select(*carried, F.col("text").alias(free_name(carried))).mapInArrow(
        run, f"{kinds}, ids array<int>, parity boolean"
    )


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; null ids give null."""
    carried = others(encoded, ("decoded",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            texts = [
                codec.decode(x.values.to_numpy()) if x.is_valid else None for x in batch.column(len(carried))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*carried, "decoded"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in carried)
    return encoded.select(*carried, F.col("ids").alias(free_name(carried))).mapInArrow(run, f"{kinds}, decoded string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): number and crc32 of its ids, parity, and whether its ids decode to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                ids, bounds, same = codec.encode(texts)
                each = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                back = [
                    text is None or codec.decode(ids[a:b]) == text.replace(MARK, " ")
                    for (a, b), text in zip(each, texts.to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in each], pa.int64()),
                        pa.array(same),
                        pa.array(back),
                    ],
                    names=["doc_id", "n_ids", "ids_crc32", "parity", "round_trip"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean"
    )
