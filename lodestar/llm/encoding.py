"""Encoding whole texts with a file of the ``tokenizers`` library.

The vocabularies used here break a text into pieces before any merge, and some
places are always between two pieces.  So the encoding of a text is the
encodings of its chunks, cut at such places, one after the other.
``ChunkEncoder`` cuts a column of texts into chunks, asks the library once for
each chunk it has not met, and strings the ids together; a chunk longer than
``LONG`` bytes is never remembered.

Places that are cut, where a *visible* character is printable ASCII or a letter
U+00C0 to U+00FF:

* before a single space, and before and after a single line feed, between two
  visible characters;
* between a letter (ASCII or U+00C0 to U+00FF) and an ASCII mark after it.

Any other place is left inside its chunk, where the library decides.  A chunk of
letters only, or of marks only, is one piece, so the library's model gets it
directly; other chunks go through the whole tokenizer.  Files of another
make (``_kind``) are not cut at all.  The strings of special tokens are ordinary text.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np

from lodestar.llm.bytescan import hash_spans, lower_ascii, ragged_arange, sums_by_run, text_slices

LONG = 256
#: Remembered chunks; beyond it the memory starts anew (ids are the same either way).
CACHE_CHUNKS = 2_000_000

_BYTE = np.arange(256)
_PRINTABLE = (_BYTE > 0x20) & (_BYTE < 0x7F)
_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
_MARK = _PRINTABLE & ~_LETTER & ~((_BYTE >= 48) & (_BYTE <= 57))


def _byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if visible, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _kind(path: str) -> str:
    """``bytes``: byte-level pieces that keep their spaces; ``words``: lower-cased pieces without spaces; else ``other``."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    before, steps = made.get("pre_tokenizer") or {}, (made.get("normalizer") or {}).get("normalizers", [])
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not made.get("normalizer"):
        return "bytes"
    split = (before.get("pretokenizers") or [{}])[0]
    if [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and split.get("invert"):
        return "words"
    return "other"


class ChunkEncoder:
    most = CACHE_CHUNKS  # chunks that this one remembers, if that is less

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.kind = _kind(path)
        self.symbols = _byte_symbols()
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)          # sorted
        self.slots = np.zeros(0, np.int64)          # of each key, its place in ``ends``
        self.ids = np.zeros(1 << 16, np.uint32)     # of all chunks, in order of arrival
        self.ends = np.zeros(1 << 12, np.int64)     # ``ends[i]`` to ``ends[i + 1]`` are the ids of chunk i
        self.n_ids = self.n_chunks = 0

    def _encode(self, texts: list[bytes], one_piece: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        found: list = [None] * len(texts)
        tokenize, symbols, fold = self.model.tokenize, self.symbols, self.kind == "words"
        rest = []
        for i, (t, one) in enumerate(zip(texts, one_piece)):
            if one:
                if fold and not t.isascii():
                    t = t.decode().lower().encode()
                found[i] = [x.id for x in tokenize(t.decode("latin-1").translate(symbols))]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _add(self, keys: np.ndarray, texts: list[bytes], one_piece: list[bool]) -> None:
        """Remember new chunks; ``keys`` ascend."""
        flat, sizes = self._encode(texts, one_piece)
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n_chunks + len(texts) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        self.ends[self.n_chunks + 1:self.n_chunks + 1 + len(texts)] = self.n_ids + np.cumsum(sizes)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.slots = np.insert(self.slots, at, np.arange(self.n_chunks, self.n_chunks + len(texts)))
        self.n_ids += len(flat)
        self.n_chunks += len(texts)

    def _is_new(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] != keys

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the chunks of all texts, and which are one piece."""
        if self.kind == "other":
            starts, ends = offsets[:-1], offsets[1:]
            full = ends > starts
            return starts[full], ends[full], np.zeros(int(full.sum()), bool)
        # Letters U+00C0 to U+00FF are the byte C3 and one of 80 to BF, but for the signs at 97 and B7.
        letter = _LETTER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        lead = lead[(tail >= 0x80) & (tail < 0xC0) & (tail != 0x97) & (tail != 0xB7)]
        wide_end = np.zeros(len(data), bool)
        wide_end[lead + 1] = True
        visible_start = _PRINTABLE[data]
        visible_end = visible_start | wide_end
        visible_start[lead] = True
        mark = _MARK[data]
        gap = (data[1:-1] == 0x20) | (data[1:-1] == 0x0A)
        gap = np.flatnonzero(gap & visible_end[:-2] & visible_start[2:]) + 1
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = cut[gap] = True
        cut[gap[data[gap] == 0x0A] + 1] = True
        cut[1:-1] |= mark[1:] & (letter[:-1] | wide_end[:-1])
        bounds = np.flatnonzero(cut)
        starts, ends = bounds[:-1], bounds[1:]
        letter[lead] = letter[lead + 1] = True
        begin = starts + (data[starts] == 0x20)
        n_letters, n_marks = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (letter, mark))
        size = ends - begin
        one = (size > 0) & ((n_letters[ends] - n_letters[begin] == size) | (n_marks[ends] - n_marks[begin] == size))
        return (np.where(one, begin, starts) if self.kind == "words" else starts), ends, one

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: the ids of all texts one after the other, and how many each text has."""
        parts, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in text_slices(column):
            if not len(data):
                counts.append(np.zeros(len(offsets) - 1, np.int64))
                continue
            if self.kind == "words":
                data = lower_ascii(data)
            starts, ends, one = self._chunks(data, offsets)
            short = ends - starts <= LONG
            uniq, first, inverse = np.unique(hash_spans(data, starts, ends)[short], return_index=True, return_inverse=True)
            raw, s, e, o = data.tobytes(), starts[short][first], ends[short][first], one[short][first]
            new = np.flatnonzero(self._is_new(uniq))
            if self.n_chunks + len(new) > min(CACHE_CHUNKS, self.most):
                self._clear()
                new = np.arange(len(uniq))
            if len(new):
                self._add(uniq[new], [raw[i:j] for i, j in zip(s[new].tolist(), e[new].tolist())], o[new].tolist())
            slots = self.slots[np.searchsorted(self.keys, uniq)][inverse]
            at, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
            at[short] = self.ends[slots]
            size[short] = self.ends[slots + 1] - self.ends[slots]
            source = self.ids
            if not short.all():
                lost = np.flatnonzero(~short)
                flat, sizes = self._encode([raw[starts[i]:ends[i]] for i in lost.tolist()], one[lost].tolist())
                size[lost], at[lost] = sizes, self.n_ids + np.cumsum(sizes) - sizes
                source = np.concatenate([self.ids[:self.n_ids], flat])
            parts.append(source[ragged_arange(at, size)])
            counts.append(sums_by_run(size, np.searchsorted(starts, offsets)))
        return np.concatenate(parts), np.concatenate(counts)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def append_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts with ``end_id`` after each text."""
    counts = counts + 1
    out = np.empty(int(counts.sum()), np.uint32)
    last = np.cumsum(counts) - 1
    keep = np.ones(len(out), bool)
    keep[last] = False
    out[keep] = ids
    out[last] = end_id
    return out, counts
