"""Dealing the (document, key) pairs of a corpus by key, packed, and back by batch.

A corpus has about one word or n-gram per seven bytes of text, too many for a
row each.  A task gathers the pairs of some thousand documents, a *batch*, and
sends one row per batch and *bucket* (a range of the 64-bit keys) with the
pairs as arrays in binary columns.  Whoever groups by bucket sees all pairs of
a key together; grouping its answers by batch brings them back to the
documents.  Documents of a batch are numbered; what is known of them (``docs``)
travels in one of the batch's rows only.

A key that many documents of one batch share would make its bucket large.  The
pairs of such *hot* keys (``hot`` documents of the batch or more, see ``dealing``) stay with
the batch: they go to a bucket of their own, chosen by batch, and the key's
bucket gets one pair with the number ``MARK`` in their place, whose extra value may sum
theirs up.  So a key's bucket gets less than ``hot`` pairs of it from each batch, and ``hot`` falls as the
batches grow in number, so that a key has less than ``KEY_PAIRS`` pairs (24 MB) in its bucket; it is
never below 2, which is reached at some 3 TB of text, and from there on a key of every batch grows
by one pair a batch (100 TB: about 25 million pairs).

Batches are numbered by partition and order in it, so the documents must come
in the same order if a task runs again.  A scan of stored files does; callers
store anything else first (``components.stored``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 256
MARK = 0xFFFF
MAX_DOCS = 20_000
MAX_PAIRS = 1_000_000
BUCKET_BYTES = 24 << 20
KEY_PAIRS = BUCKET_BYTES // 16
#: A batch holds about so much text, or so many rows, at least (short of the last one of a task).
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000
SCHEMA = "bucket int, batch long, keys binary, numbers binary, extra binary, docs binary, hot boolean"
_FIELDS = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("numbers", pa.binary()),
                     ("extra", pa.binary()), ("docs", pa.binary()), ("hot", pa.bool_())])


def dealing(docs: DataFrame, text: str = "text", bytes_per_byte: float = 1.0) -> tuple[int, int]:
    """``(buckets, hot)``: so many buckets that each holds about ``BUCKET_BYTES``, from the bytes of all texts, never fewer than
    shuffle partitions; and from how many documents of a batch on a key is hot."""
    total, rows = docs.agg(F.sum(F.octet_length(F.col(text))), F.count(F.lit(1))).first()
    total = total or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total * bytes_per_byte) // BUCKET_BYTES))
    return buckets, hot_limit(total, rows)


def hot_limit(total: int, rows: int) -> int:
    return max(2, min(HOT, KEY_PAIRS // (1 + total // BATCH_BYTES + rows // BATCH_ROWS)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def to_planes(values: np.ndarray) -> bytes:
    """Little-endian 64-bit values byte by byte, all first bytes first: the high bytes of sorted keys compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def pack(batch: int, keys: np.ndarray, numbers: np.ndarray, extra: np.ndarray | None, docs: bytes, buckets: int,
         hot: int = HOT, summed: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> pa.RecordBatch:
    """The rows of one batch; ``numbers`` are documents of the batch (below ``MARK``), ``extra`` any array beside them.

    ``summed`` makes the extra values of marks, from those of all pairs by key and the places at which each key
    begins; without it a mark has its key's first one."""
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order].astype("<u2")
    extra = extra[order] if extra is not None else None
    rows = []
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(keys)))
    if len(keys) and count.max() >= hot:
        is_hot = np.repeat(count >= hot, count)
        rows.append((buckets + batch % buckets, to_planes(keys[is_hot]), numbers[is_hot].tobytes(),
                     extra[is_hot].tobytes() if extra is not None else None, None, True))
        marks = keys[first[count >= hot]]
        beside = (extra[first] if summed is None else summed(extra, first))[count >= hot] if extra is not None else None
        keys, numbers = np.concatenate([keys[~is_hot], marks]), np.concatenate([numbers[~is_hot], np.full(len(marks), MARK, "<u2")])
        extra = np.concatenate([extra[~is_hot], beside]) if extra is not None else None
        order = np.argsort(keys, kind="stable")
        keys, numbers, extra = keys[order], numbers[order], extra[order] if extra is not None else None
    home = batch % buckets
    bounds = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero((np.diff(bounds) > 0) | (np.arange(buckets) == home)).tolist():
        s = slice(bounds[b], bounds[b + 1])
        rows.append((b, to_planes(keys[s]), numbers[s].tobytes(), extra[s].tobytes() if extra is not None else None,
                     docs if b == home else None, False))
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array([batch] * len(rows), pa.int64()), pa.array(cols[1], pa.binary()),
                                       pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary()),
                                       pa.array(cols[5], pa.bool_())], schema=_FIELDS)


def unpack(table: pa.Table, extra: type | str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """All pairs of a group of rows: keys, numbers, the row each is from, and the extra values."""
    keys = [from_planes(x) for x in table["keys"].to_pylist()]
    numbers = [np.frombuffer(x, "<u2") for x in table["numbers"].to_pylist()]
    more = [np.frombuffer(x, extra) for x in table["extra"].to_pylist()] if extra else None
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    return np.concatenate(keys), np.concatenate(numbers), row, np.concatenate(more) if extra else None
