"""Vectorised scans over the UTF-8 bytes of a column of texts.

An Arrow string column holds all its texts in one byte buffer.  The helpers
here find words in that buffer, hash them and hash runs of words with a few
numpy passes, so no operator loops over words in Python.  A batch is worked
off in slices of a few megabytes (``text_slices``), so the scratch arrays stay
small whatever the batch holds; one text is never cut.

Hashes are 64 bits wide and name words and runs of words.  Every step goes
through a mixing function before it is added or combined (``hash_spans``,
``hash_windows``): sums of powers modulo 2**64 would give one hash to some words by
construction, such as a Thue-Morse word and its complement.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Masks for the first 0 to 8 bytes of a little-endian block.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def byte_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """True for each byte outside the given inclusive ranges."""
    table = np.ones(256, bool)
    for lo, hi in excluded:
        table[lo:hi + 1] = False
    return table


#: Words ``[^\\x20\\x09-\\x0D]+``.
NOT_SPACE = byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (of lower-cased text).
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``len + 1`` offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off.astype(np.int64)


def text_slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, data, offsets)`` for runs of whole texts of about ``max_bytes``.

    ``offsets`` are relative to ``data``.  A longer text is a run of its own.
    """
    raw, off = string_buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and for each text the number of its first word (``len + 1`` values)."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    word = table[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[word[cut] & word[cut - 1]]  # a word ends and another begins between two texts
    flips = np.flatnonzero(edge)
    if len(cut):
        flips = np.sort(np.concatenate([flips, cut, cut]))
    starts, ends = flips[0::2], flips[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit hangs on all others."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def _place(n: np.ndarray) -> np.ndarray:
    """A value for each place of a block in its run."""
    return mix(n.astype(np.uint64) * _STEP + _M1)


def _blocks(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of ``data`` as a number, zeros beyond its end; a view."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``; equal runs get equal hashes wherever they stand.

    Bytes are taken 8 at a time, other values one at a time.  Each of these blocks is mixed with
    its place in the run; the sum of the mixed blocks and the length are mixed again.
    """
    size = np.asarray(ends, np.int64) - starts
    if values.dtype == np.uint8:
        step, blocks = 8, _blocks(values)
        tail = _FIRST_BYTES[np.where(size > 0, (size - 1) % 8 + 1, 0)]
    else:
        step, blocks, tail = 1, np.append(values.astype(np.uint64), np.uint64(0)), None
    count = np.maximum(-(-size // step), 1)                             # an empty run has one block, masked below
    first = blocks[starts]
    if tail is None:
        first = np.where(size > 0, first, np.uint64(0))
    else:
        first = np.where(count > 1, first, first & tail)
    total = mix(first ^ _place(np.zeros(1)))
    longer = np.flatnonzero(count > 1)
    for lo in range(0, len(longer), 1 << 16):                           # so many runs at a time, for the memory of their blocks
        some = longer[lo:lo + (1 << 16)]
        rest = count[some] - 1
        place = ragged_arange(np.ones(len(some), np.int64), rest)
        block = blocks[np.repeat(starts[some], rest) + place * step]
        bounds = np.cumsum(rest)
        if tail is not None:
            block[bounds - 1] &= tail[some]
        total[some] += np.add.reduceat(mix(block ^ _place(place)), bounds - rest)
    return mix(total + size.astype(np.uint64) * _M2)


def hash_windows(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` values from each place ``at``; equal windows get equal hashes.

    Hashes of 1, 2, 4, ... values are each mixed from two of half the size, and those that
    the binary digits of ``size`` name are joined.  (Not the hashes that ``hash_spans`` gives.)
    """
    if not len(at):
        return np.zeros(0, np.uint64)
    half, span, found, done = mix(values.astype(np.uint64)), 1, None, 0
    while True:
        if size & span:
            found = half[:len(values) - size + 1] if found is None else _joined(found, half[done:done + len(values) - size + 1])
            done += span
        if done == size:
            return found[at]
        half, span = _joined(half[:-span], half[span:]), 2 * span


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _STEP
    h += b
    return mix(h)


def window_starts(first_word: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the words at which ``size`` words of one text begin."""
    n = np.maximum(np.diff(first_word) - (size - 1), 0)
    return ragged_arange(first_word[:-1], n)


def ragged_arange(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` of them) for every i, in one array."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(np.asarray(starts, np.int64) - (np.cumsum(counts) - counts), counts)


def sums_by_run(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``values[bounds[i]:bounds[i + 1]]`` for every i (0 for an empty run)."""
    total = np.concatenate([np.zeros(1, np.int64 if values.dtype.kind in "bui" else np.float64), np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]
