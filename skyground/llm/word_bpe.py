"""Ids of a word-level BPE tokenizer file, by chunks between white space.

The tokenizer cuts a text into pieces by a fixed pattern, drops white space, and never joins across
pieces, so the ids of a text are the ids of its pieces end to end. Texts of plain letters, digits and
punctuation are lowered and cut by Arrow, and each distinct piece goes to the tokenizer's BPE model once. Other
texts are cut at white space: plain chunks take the same way, the rest the whole tokenizer.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from skyground.llm.chunks import ChunkCache, encode_lists

# Fixed value: the split pattern of the tokenizer file, for letters up to U+024F.
LETTERS = "a-zªµºß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĳĵķĸĺļľŀłńņňŉŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžſ"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
#: Characters for which lowering and the pattern above are the tokenizer's: printable ASCII and the letters.
PLAIN = re.compile(rf"[!-~{LETTERS}À-ÖØ-ÞĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮĲĴĶĹĻĽĿŁŃŅŇŊŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽ]*")
#: The pattern's pieces other than runs of letters, for setting blanks around them.
APART = r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s" + LETTERS + r"0-9]+)"
#: A character that is neither plain nor one of the blanks at which Arrow cuts.
NOT_PLAIN = PLAIN.pattern.removesuffix("*").replace("[", r"[^ \t\n\v\f\r", 1)
BATCH = 1000


def _byte_letters() -> dict[int, str]:
    """The letter byte-level tokenizers write for each byte: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encodes lists of texts; one per worker process and file."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.latin = _byte_letters()
        self.pieces = ChunkCache(self._encode_pieces)
        self.chunks = ChunkCache(self._encode_chunks)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Many pieces ride in one string; the model never joins across the blanks."""
        out: list[bytes] = []
        # Arrow cuts an empty piece before a leading and after a trailing blank.
        spelt = [p if p.isascii() else p.encode().decode("latin-1").translate(self.latin) for p in pieces if p]
        batches = [spelt[i : i + BATCH] for i in range(0, len(spelt), BATCH)]
        done = self.model.encode_batch([" ".join(b) for b in batches], add_special_tokens=False)
        for batch, encoding in zip(batches, done, strict=True):
            ids = np.array(encoding.ids, "<u4")
            words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
            ends = np.searchsorted(words, np.arange(len(batch)), side="right")
            begin = 0
            for end in ends.tolist():
                out.append(ids[begin:end].tobytes())
                begin = end
        found = iter(out)
        return [next(found) if p else b"" for p in pieces]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        plain = [i for i, c in enumerate(chunks) if PLAIN.fullmatch(c) and "<|" not in c]
        cut = [PIECES.findall(chunks[i].lower()) for i in plain]
        distinct = list({p for ps in cut for p in ps})
        known = dict(zip(distinct, self.pieces.ids(distinct), strict=True)) if distinct else {}
        out: list[bytes | None] = [None] * len(chunks)
        for i, ps in zip(plain, cut, strict=True):
            out[i] = b"".join(map(known.__getitem__, ps))
        odd = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(
            odd, self.whole.encode_batch([chunks[i] for i in odd], add_special_tokens=False), strict=True
        ):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end and where each text's start; null is empty."""
        texts = texts.fill_null("")
        odd = pc.or_(pc.match_substring_regex(texts, NOT_PLAIN), pc.match_substring(texts, "<|"))
        plain = pc.replace_substring_regex(pc.utf8_lower(texts.filter(pc.invert(odd))), APART, r" \1 ")
        parts = [
            encode_lists(pc.ascii_split_whitespace(plain), self.pieces),
            encode_lists(pc.ascii_split_whitespace(texts.filter(odd)), self.chunks),
        ]
        if not len(parts[1][1]) > 1:
            return parts[0]
        # Put the two kinds of text back into their order.
        sizes = np.empty(len(texts), np.int64)
        starts = np.empty(len(texts), np.int64)
        kind = odd.to_numpy(zero_copy_only=False)
        for mask, (_, ends), shift in ((~kind, parts[0], 0), (kind, parts[1], len(parts[0][0]))):
            sizes[mask], starts[mask] = np.diff(ends), ends[:-1] + shift
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        return np.concatenate([parts[0][0], parts[1][0]])[places], ends


@lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
