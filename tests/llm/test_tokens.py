"""Packing and SentencePiece against the tokenizers themselves."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyground.llm import packing, piece_codec
from skyground.llm.chunks import ENTRY_BYTES, ChunkCache
from skyground.llm.word_bpe import word_bpe

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello  <|endoftext|> world's É́ naïve ſtraße İstanbul ΑΣ \x1cab cd 中文 it's 12 ab12!?",
    "",
    None,
    " leading and trailing ",
    "ŉ don't I'LL ₂ ² a\x00b x y",
    "'s 't!'re ''ve don''t a'b'c",
    "tabs\tand\r\nlines\x0b\x0c",
    "a" * 400,
]


def test_word_ids_are_the_tokenizers():
    ids, bounds = word_bpe(WORD).encode(pa.array(TEXTS))
    whole = Tokenizer.from_file(WORD)
    for i, text in enumerate(TEXTS):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_chunk_cache_is_bounded_by_bytes():
    asked = []

    def encode(chunks):
        asked.extend(chunks)
        return [c.encode() for c in chunks]

    cache = ChunkCache(encode, remembered=100_000)
    for i in range(3000):
        assert cache.ids([f"w{i}", "often", f"w{i}", "x" * 60_000]) == [f"w{i}".encode(), b"often", f"w{i}".encode(), b"x" * 60_000]
        held = sum(ENTRY_BYTES + len(c) + len(b) for part in (cache.young, cache.old) for c, b in part.items())
        assert held <= 100_000
    # What is in use stays, whatever else goes by; what is larger than a generation is encoded each time.
    assert asked.count("often") == 1 and asked.count("w0") == 1 and asked.count("x" * 60_000) == 3000
    cache.ids(["w0"])
    assert asked.count("w0") == 2


def test_ids_are_the_rebuilt_models(monkeypatch):
    """A broken rebuild shows: parity goes, and only then the library's ids are taken."""
    codec = piece_codec.PieceCodec(PIECE)
    texts = pa.array(["hello wide world", "more words"])
    ids, bounds, same = codec.encode(texts)
    assert same.all()
    broken = piece_codec.PieceCodec(PIECE)
    other = Tokenizer.from_str(broken.rebuilt.to_str())
    other.normalizer = piece_codec.normalizers.Sequence([piece_codec.normalizers.Lowercase(), piece_codec.normalizers.Replace("o", "0")])
    broken.rebuilt = other
    again, _, odd = broken.encode(texts)
    assert not odd.any() and again.tolist() == ids.tolist()


def test_sweep_places_everything_once():
    rng = np.random.default_rng(5)
    sizes = np.minimum(100, rng.geometric(0.05, 3000))
    counts = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)], strict=True))
    plan, made = packing.sweep(counts, 100)
    used = defaultdict(list)
    for length in counts:
        rows = plan[plan[:, 0] == length]
        rows = rows[np.argsort(rows[:, 1])]
        for k in range(counts[length]):
            _, rank, first, offset = rows[np.searchsorted(rows[:, 1], k, side="right") - 1]
            used[first + k - rank].append((offset, length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 100
    assert len(used) == made
    assert made <= -(-int(sizes.sum()) // 100) * 1.02 + 1


def test_pack(spark, documents, clashing, nothing):
    rows = packing.pack(documents, WORD, capacity=64).collect()
    whole = Tokenizer.from_file(WORD)
    pieces = defaultdict(list)
    for r in documents.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]
        for i in range(0, len(ids), 64):
            part = np.array(ids[i : i + 64], "<u4")
            pieces[r.doc_id].append((i // 64, i, len(part), zlib.crc32(part.tobytes())))
    got = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in pieces.items()}
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(clashing, WORD, capacity=64).count() == len(rows)
    assert packing.pack(nothing, WORD).count() == 0


def test_piece_ids_are_the_librarys(spark, documents, clashing, nothing):
    texts = [*TEXTS, "  two  spaces ", " ", "   ", "a\nb \n c", "▁x ▁▁y", "😀 é́"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    out = piece_codec.decode(piece_codec.encode(docs, PIECE), PIECE).collect()
    for r in out:
        if r.text is None:
            assert r.ids is None and r.decoded is None
            continue
        assert r.ids == library.encode(r.text) and r.parity
        assert r.decoded == library.decode(r.ids) == r.text.replace("▁", " ")
    assert piece_codec.encode(clashing, PIECE).count() == clashing.count()
    assert piece_codec.digests(nothing, PIECE).count() == 0
    got = piece_codec.digests(documents, PIECE).collect()
    assert len(got) == documents.count() and all(r.round_trip and r.parity for r in got)


def test_unigram_rebuild():
    proto = piece_codec.pb.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -1, 1), ("▁a", -2.2, 1)]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type = piece_codec.UNIGRAM
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    rebuilt = piece_codec.rebuild(proto)
    assert rebuilt.encode(" abab", add_special_tokens=False).tokens == ["▁", "ab", "ab"]
    proto.trainer_spec.model_type = 3
    with pytest.raises(ValueError):
        piece_codec.rebuild(proto)
