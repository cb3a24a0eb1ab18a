"""Packing token sequences into windows by minimum bin slack.

A document is encoded, given its end id and cut into pieces of ``capacity``
tokens; each whole piece is a sequence by itself.  The remainders, one per
document at most, are packed by length: the longest one left opens a window,
and a subset-sum table over the lengths left, kept as bitsets, finds the
multiset that fills the window closest to its capacity.  Walking the bitsets
back gives how many pieces of each length to take.  The same filling is
repeated as often as the counts allow.

Documents are packed where they lie: every task packs the remainders of its
own rows, ``pool`` at a time, so nothing is shuffled, one task never holds more
than ``pool`` lengths, and a hot key makes no difference.  Only the last few
windows of a pool stay short.  ``sequence_id`` joins the number of the
partition with a running number, so it is unique but not gapless.

Defined results: a null or empty text is the end id alone; rows of one doc_id,
null ids and repeated rows are documents of their own; an empty table gives no
piece.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lodestar.llm.encoding import append_end, encoder

POOL = 20_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_filling(room: int, counts: dict[int, int]) -> dict[int, int]:
    """How many pieces of each length sum closest to ``room`` without passing it, given ``counts`` of each length."""
    mask, reach, stages = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        stages.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            reach |= (reach << (step * length)) & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(stages):
        taken = 0
        while not before >> total & 1:
            total -= length
            taken += 1
        if taken:
            used[length] = taken
    return used


def minimum_slack(lengths: list[int], capacity: int) -> list[list[int]]:
    """The windows, each a list of positions in ``lengths`` (all from 1 to ``capacity``)."""
    stacks: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        stacks[n].append(i)
    for s in stacks.values():
        s.reverse()
    counts = {n: len(s) for n, s in stacks.items()}
    windows = []
    for longest in sorted(stacks, reverse=True):
        while counts.get(longest):
            counts[longest] -= 1
            if not counts[longest]:
                del counts[longest]
            used = best_filling(capacity - longest, counts)
            counts[longest] = counts.get(longest, 0) + 1
            used[longest] = used.get(longest, 0) + 1
            times = min(counts[n] // k for n, k in used.items())
            for n, k in used.items():
                counts[n] -= k * times
                if not counts[n]:
                    del counts[n]
            for _ in range(times):
                windows.append([stacks[n].pop() for n, k in used.items() for _ in range(k)])
    return windows


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, pool: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    serial = (task.partitionId() if task else 0) << 32
    pieces: list[tuple] = []      # whole windows: rows ready to go out
    rests: list[tuple] = []       # (doc_id, start, length, crc, doc_tokens)

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def pack() -> list[tuple]:
        nonlocal serial
        rows = []
        for window in minimum_slack([r[2] for r in rests], capacity):
            at = 0
            for i in window:
                rows.append((*rests[i], serial, at))
                at += rests[i][2]
            serial += 1
        rests.clear()
        return rows

    for batch in batches:
        ids, counts = append_end(*encoder(path).encode(batch.column(1)), end_id)
        ids = ids.astype("<u4")
        raw, end = memoryview(ids.tobytes()), 0
        for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist()):
            for start in range(0, n, capacity):
                size = min(capacity, n - start)
                row = (doc_id, start, size, zlib.crc32(raw[4 * (end + start):4 * (end + start + size)]), n)
                if size == capacity:
                    pieces.append((*row, serial, 0))
                    serial += 1
                else:
                    rests.append(row)
            end += n
            if len(rests) >= pool:
                pieces += pack()
            if len(pieces) >= pool:
                yield flush(pieces)
                pieces = []
    yield flush(pieces + pack())


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, pool: int = POOL,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: document, first token, length, checksum of its ids (little-endian, 32 bits), sequence and offset there."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _pack_partition(it, tokenizer_path, end_id, capacity, pool), SCHEMA)
