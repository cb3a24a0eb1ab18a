"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: every run of ``size``
consecutive words, or all words of a shorter item.  Words get small numbers (0:
not in any pattern), and patterns of one length are searched together.  A *block*
is two neighbouring words (one, for patterns of one word).  The shift table says
for each hashed block how far the window may move without missing a pattern: the
least distance of the block from the end of any pattern that holds it, and
``length - 1`` for other blocks.  Where the shift is 0, the patterns whose
last block is this one (the suffix-hash bucket) are compared word by word.

Documents are searched in many *lanes* at a time, runs of up to ``LANE`` window
starts, which all move by their own shifts; so whole texts are searched
whatever their length, with numpy steps over all lanes of a slice.

The benchmark is broadcast in shards of at most ``shard_bytes`` of text; a larger one
takes one narrow pass over the documents for each shard, written between passes.  Repeated items are
dropped and items of more than a shard are cut into overlapping parts in Spark; the
rest is summed by hash range before anything is collected, and ranges make the shards.
(Only ``size`` words that are longer than a shard together make a larger one.)  Documents are never shuffled, so copies
and hot keys make no difference.

Defined results: null and empty texts have no words; an item without words
matches nothing; items with the same id count once, a null id counts as the
id ``''``; an empty benchmark hits nothing; rows keep their order, repeated rows
stay, and columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bytescan import ALNUM, find_words, hash_spans, lower_ascii, ragged_arange, text_slices
from lodestar.llm.components import stored

SIZE = 10
LANE = 64
SHARD_BYTES = 32 << 20
TABLE_BITS = 20
RESULTS = ["n_words", "spans", "items"]


@dataclass
class Patterns:
    """Patterns of one length with their Wu-Manber tables."""

    words: np.ndarray        # one pattern a row, in order of the hashed last block
    shift: np.ndarray        # by hashed block
    bucket: np.ndarray       # first pattern of each hashed block, and one more
    item_at: np.ndarray      # the items of pattern i are items[item_at[i]:item_at[i + 1]]
    items: np.ndarray


def _block_hash(t: np.ndarray, at: np.ndarray, single: bool) -> np.ndarray:
    h = t[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if not single:
        h += t[at - 1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def build_patterns(windows: np.ndarray, items: np.ndarray) -> Patterns:
    """Tables for ``windows`` (a pattern a row, word numbers) that belong to ``items``."""
    words, which = np.unique(windows, axis=0, return_inverse=True)
    which = which.reshape(-1)
    m = words.shape[1]
    single = m == 1
    flat = words.reshape(-1)
    ends = np.arange(len(words)) * m
    last = _block_hash(flat, ends + m - 1, single)
    order = np.argsort(last, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    shift = np.full(1 << TABLE_BITS, max(m - 1, 1), np.uint8 if m < 256 else np.int64)
    for j in range(0 if single else 1, m):
        np.minimum.at(shift, _block_hash(flat, ends + j, single), m - 1 - j)
    pairs = np.unique(np.stack([rank[which], items], 1), axis=0)
    return Patterns(words[order], shift, np.searchsorted(last[order], np.arange((1 << TABLE_BITS) + 1)),
                    np.searchsorted(pairs[:, 0], np.arange(len(words) + 1)), pairs[:, 1])


def search(t: np.ndarray, first_word: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """``(start, pattern)`` of every occurrence in the word numbers ``t``; no occurrence passes a text's end."""
    m = p.words.shape[1]
    single = m == 1
    n = np.maximum(np.diff(first_word) - (m - 1), 0)                # window starts of each text
    lanes = -(-n // LANE)
    lane = ragged_arange(np.zeros(len(n), np.int64), lanes)         # number of the lane in its text
    text = np.repeat(np.arange(len(n)), lanes)
    at = first_word[text] + lane * LANE + m - 1                     # the window's last word
    stop = first_word[text] + np.minimum((lane + 1) * LANE, n[text]) + m - 1
    found = []
    while len(at):
        step = p.shift[_block_hash(t, at, single)].astype(np.int64)
        found.append(at[step == 0])
        at = at + np.maximum(step, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    h = _block_hash(t, at, single)
    size = p.bucket[h + 1] - p.bucket[h]
    start, pattern = np.repeat(at - (m - 1), size), ragged_arange(p.bucket[h], size)
    for j in range(m):
        same = t[start + j] == p.words[pattern, j]
        start, pattern = start[same], pattern[same]
    return start, pattern


def prepare(texts: list[str | None], ids: list[str], size: int) -> tuple[np.ndarray, list[Patterns], list[str]]:
    """Sorted word hashes (word numbers are 1 more than the place), the patterns by length, and the item ids."""
    names = sorted(set(ids))
    number = {x: i for i, x in enumerate(names)}
    hashes, first = [], [0]
    for _, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        data = lower_ascii(data)
        starts, ends, firsts = find_words(data, offsets, ALNUM)
        hashes.append(hash_spans(data, starts, ends))
        first += (firsts[1:] + first[-1]).tolist()
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    vocabulary = np.unique(hashes)
    t = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
    by_length: dict[int, tuple[list, list]] = {}
    for i, (a, b) in enumerate(zip(first, first[1:])):
        m = min(size, b - a)
        if m:
            rows, owners = by_length.setdefault(m, ([], []))
            rows.append(np.lib.stride_tricks.sliding_window_view(t[a:b], m))
            owners.append(np.full(b - a - m + 1, number[ids[i]]))
    return vocabulary, [build_patterns(np.concatenate(r), np.concatenate(o)) for _, (r, o) in sorted(by_length.items())], names


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans, ascending (spans of different texts never touch here)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)] if len(end) else end


def _search_batch(column, vocabulary: np.ndarray, patterns: list[Patterns], names: list[str]):
    """n_words, spans and items of every text of ``column``."""
    n_words, spans_n, span_s, span_e, items_n, items = [], [], [], [], [], []
    for _, _, data, offsets in text_slices(column):
        data = lower_ascii(data)
        starts, ends, first = find_words(data, offsets, ALNUM)
        n_words.append(np.diff(first))
        k = len(offsets) - 1
        hashes = hash_spans(data, starts, ends)
        at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
        t = np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.int32) if len(vocabulary) else np.zeros(len(hashes), np.int32)
        # A gap of one place between texts keeps the spans of neighbours apart.
        s_all, e_all, i_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
        for p in patterns:
            start, which = search(t, first, p)
            text = np.searchsorted(first, start, "right") - 1
            s_all.append(start + text)
            e_all.append(start + text + p.words.shape[1])
            size = p.item_at[which + 1] - p.item_at[which]
            i_all.append(np.stack([np.repeat(text, size), p.items[ragged_arange(p.item_at[which], size)]], 1))
        s, e = _merged(np.concatenate(s_all), np.concatenate(e_all))
        text = np.searchsorted(first + np.arange(k + 1), s, "right") - 1
        spans_n.append(np.bincount(text, minlength=k))
        span_s.append(s - text - first[text])
        span_e.append(e - text - first[text])
        pairs = np.unique(np.concatenate(i_all), axis=0)
        items_n.append(np.bincount(pairs[:, 0], minlength=k))
        items += [names[i] for i in pairs[:, 1].tolist()]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    offsets_of = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    spans = pa.StructArray.from_arrays([pa.array(join(span_s), pa.int32()), pa.array(join(span_e), pa.int32())], names=["start", "end"])
    return (pa.array(join(n_words), pa.int64()), pa.ListArray.from_arrays(offsets_of(join(spans_n)), spans),
            pa.ListArray.from_arrays(offsets_of(join(items_n)), pa.array(items, pa.string())))


def _parts(batches: Iterator[pa.RecordBatch], size: int, most: int) -> Iterator[pa.RecordBatch]:
    """Items, those of more than ``most`` bytes as parts of about half as many that share ``size - 1`` words, so every window is in one."""
    for batch in batches:
        ids, texts = [], []
        for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            raw = text.encode()
            if len(raw) <= most:
                ids.append(name)
                texts.append(text)
                continue
            starts, ends, _ = find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM)
            at, windows = 0, max(len(starts) - size + 1, min(len(starts), 1))
            while at < windows:
                after = max(at + 1, int(np.searchsorted(starts, starts[at] + most // 2)))
                ids.append(name)
                texts.append(raw[starts[at]:ends[min(after + size - 1, len(starts)) - 1]].decode())
                at = after
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["id", "text"])


def deal_shards(items: DataFrame, shard_bytes: int) -> tuple[Column, list[tuple[int, int, int]]]:
    """A number of each row of ``items`` (id, text), and for each shard the numbers ``[low, high)`` that are in it and its bytes.

    Bytes are measured; only a single row can be more than ``shard_bytes``.
    """
    size = F.octet_length("text")
    total, largest = items.agg(F.sum(size), F.max(size)).first()
    ranges = 16 * (1 + (total or 0) // shard_bytes)
    while True:
        number = F.pmod(F.xxhash64("id", "text"), F.lit(ranges))
        sums = items.groupBy(number.alias("n")).agg(F.sum(size).alias("bytes")).orderBy("n").collect()  # few: by the sum above
        if all(r["bytes"] <= max(shard_bytes, largest) for r in sums):
            break
        ranges *= 2
    shards = [(0, ranges, 0)]
    for r in sums:
        low, _, held = shards[-1]
        if held and held + r["bytes"] > shard_bytes:
            shards[-1:] = [(low, r["n"], held), (r["n"], ranges, r["bytes"])]
        else:
            shards[-1] = (low, ranges, held + r["bytes"])
    return number, shards


def _with_earlier(batch: pa.RecordBatch, found: tuple) -> tuple:
    """``found`` of one shard joined with the batch's results of the shards before: spans are merged, items listed one after the other."""
    n_words = found[0]
    k = len(n_words)
    base = np.concatenate([[0], np.cumsum(n_words.to_numpy() + 1)])  # the gap of one place keeps neighbours apart
    ends, lists = [], [[] for _ in range(k)]
    for spans, items in ((batch.column("__spans"), batch.column("__items")), found[1:]):
        row, flat = pc.list_parent_indices(spans).to_numpy(), spans.flatten()
        ends.append([base[row] + flat.field(c).to_numpy() for c in ("start", "end")])
        for x, more in zip(lists, items.to_pylist()):
            x += more
    s, e = _merged(*(np.concatenate(x) for x in zip(*ends)))
    row = np.searchsorted(base, s, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(x - base[row], pa.int32()) for x in (s, e)], names=["start", "end"])
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=k))]), pa.int32())
    return n_words, pa.ListArray.from_arrays(offsets, spans), pa.array(lists, pa.list_(pa.string()))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] | None = None, size: int = SIZE,
                   text: str = "text", item_id: str = "item_id", item_text: str = "text",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and ``n_words``, ``spans`` and ``items``.

    ``spans`` are runs of hit words as ``[start, end)`` word numbers, ascending and apart
    however many shards there are, ``items`` the ids of all items with a window here.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.where("text is not null").distinct().mapInArrow(lambda it: _parts(it, size, shard_bytes), "id string, text string")
    items = stored(items.distinct(), "benchmark")
    number, shards = deal_shards(items, shard_bytes)
    results = [f"__{c}" for c in RESULTS]
    out = docs.select(*[docs[f"`{c}`"] for c in keep], docs[text].cast("string").alias("__text"))
    for i, (low, high, _) in enumerate(shards):
        part = items.where((number >= low) & (number < high)).collect()
        tables = spark.sparkContext.broadcast(prepare([r["text"] for r in part], [r["id"] for r in part], size))

        last = i == len(shards) - 1  # then the text is not sent back

        def run(batches: Iterator[pa.RecordBatch], tables=tables, first=i == 0, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _search_batch(batch.column("__text"), *tables.value)
                if not first:
                    found = _with_earlier(batch, found)
                rest = batch.drop_columns([c for c in batch.schema.names if c in results or last and c == "__text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, *found], names=[*rest.schema.names, *results])

        fields = [f for f in out.schema.fields if f.name not in results and (f.name != "__text" or not last)]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                           + [f"{results[0]} long, {results[1]} array<struct<start:int,end:int>>, {results[2]} array<string>"])
        out = out.mapInArrow(run, schema)
        if not last:  # so a stage holds one shard's tables, however many shards there are
            out = stored(out, "shards-so-far")
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"),
                      F.array_distinct("__items").alias("items"))


def hit_words(spans: str = "spans") -> Column:
    """Number of words in the spans."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` with no benchmark window in their text; columns as they were.

    A row's own columns are kept under other names meanwhile, so none of them can clash with a result.
    """
    inner = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["text"])
    clean = find_benchmark(inner, benchmark, keep=["row"], size=size).where(F.size("spans") == 0)
    return clean.select("row.*")
