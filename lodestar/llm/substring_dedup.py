"""Substring deduplication with suffix automata of reference shards.

A *window* is ``size`` consecutive words of one document.  Every word covered by a
window whose word sequence also starts anywhere else is removed.

1. Regions.  The *key* of a window is the least hash of the ``ANCHOR``-word runs in
   it, so equal windows have equal keys.  A maximal run of neighbouring windows
   with one key is a *region*, about 14 windows.  All places of a window's
   sequence are in regions of one key, and each place is in one region only.
2. Regions are dealt by key; keys of a single region are dropped (unless a window
   repeats within it), which leaves a small part of the corpus.  Regions of equal
   content collapse to one with a count; a count of 2 or more settles all of
   its windows.
3. Reference shards.  The different regions of the keys that have several are read
   from their documents and dealt into shards of about ``SHARD_WORDS`` words by
   key.  A shard's suffix automaton is built with the number of places of
   every substring.  No text is streamed through it: the states of the shard's own
   regions are read off the path of their construction, and the state that holds
   a window says how many places it has; two or more make a span.  A shard with its whole key range
   takes the place of broadcasting every shard to every document, which would
   cost documents times shards.
4. A key whose regions do not fit a shard (``HOT_WORDS``; a passage in very many
   documents) is settled by finer keys instead: each of its windows by
   itself, counted by content, packed (``exchange``).
5. Spans go back to the documents by a hash of the text.  A span is maximal runs
   of windows; words are removed from the input as it was.

Copies of a text are counted as one text with a count from the first task on,
so they never meet as pairs.  Words and runs of words are compared by 64-bit
hashes, in the automata by the low 32 bits of each of the words in turn.

Defined results: null and empty texts have no words and stay empty; texts
shorter than a window keep all words; repeated rows are copies, so all of their
windows repeat; kept words are joined by one space; columns named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import exchange
from lodestar.llm.bytescan import NOT_SPACE, find_words, hash_spans, hash_windows, mix, string_buffers, text_slices, window_starts
from lodestar.llm.components import stored

ANCHOR = 8
SHARD_WORDS = 40_000
HOT_WORDS = 40_000
_REGION = np.dtype([("key", "<u8"), ("content", "<u8"), ("text", "<i8"), ("at", "<u4"), ("windows", "<u4"), ("copies", "<u4"), ("self", "<u4")])


def find_regions(words: np.ndarray, first_word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The regions of texts: first and last window start (word numbers), key, content hash, and whether a window repeats inside."""
    anchor = min(ANCHOR, size)
    at = window_starts(first_word, anchor)
    width, top = size - anchor + 1, np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(len(words) + size, top)
    least[at] = hash_windows(words, at, anchor)
    span = 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if width > span:
        least = np.minimum(least[:-(width - span)], least[width - span:])
    starts = window_starts(first_word, size)
    key, text = least[starts], np.searchsorted(first_word, starts, "right")
    new = np.ones(len(starts), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
    end = np.append(begin[1:], len(starts)) - 1
    region = np.cumsum(new) - 1
    code = mix(hash_windows(words, starts, size) + region.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    own = np.zeros(len(begin), bool)
    if len(twice):
        own[region[np.isin(code, twice)]] = True
    return starts[begin], starts[end], key[begin], hash_spans(words, starts[begin], starts[end] + size), own


def _emit(batches: Iterator[pa.RecordBatch], size: int, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Regions packed by bucket of their key; copies of a text in one batch are sent once, with their number.

    Regions of a key with many places in the batch stay together in a bucket of the batch's own, and
    one mark (no windows, two copies) tells the key's bucket of them.
    """
    for batch in batches:
        names, first, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
        parts = []
        for lo, hi, data, offsets in text_slices(batch.column(1).take(pa.array(first))):
            starts, ends, first_word = find_words(data, offsets, NOT_SPACE)
            begin, last, key, content, own = find_regions(hash_spans(data, starts, ends), first_word, size)
            text = np.searchsorted(first_word, begin, "right") - 1
            out = np.zeros(len(begin), _REGION)
            out["key"], out["content"], out["self"] = key, content, own
            out["text"], out["at"], out["windows"], out["copies"] = names[lo:hi][text], begin - first_word[text], last - begin + 1, copies[lo:hi][text]
            parts.append(out)
        regions = np.concatenate(parts) if parts else np.zeros(0, _REGION)
        regions = regions[np.argsort(regions["key"], kind="stable")]
        _, first, size_of = np.unique(regions["key"], return_index=True, return_counts=True)
        often = np.repeat(size_of >= hot, size_of)
        marks = regions[first[size_of >= hot]].copy()
        marks["windows"], marks["copies"] = 0, 2
        stay, regions = regions[often], np.concatenate([regions[~often], marks])
        regions = regions[np.argsort(regions["key"], kind="stable")]
        bounds = np.searchsorted(exchange.bucket_of(regions["key"], buckets), np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(bounds)).tolist()
        rows = [regions[bounds[b]:bounds[b + 1]].tobytes() for b in used]
        if len(stay):
            used.append(buckets + int(names[0] % buckets))
            rows.append(stay.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(rows, pa.binary())], names=["bucket", "regions"])


_ENTRY = "key long, content long, text long, at long, windows long, copies long, self boolean"


def _repeated(table: pa.Table, buckets: int) -> pa.Table:
    """Of one bucket, the regions whose key has another place or whose windows repeat inside."""
    r = np.concatenate([np.frombuffer(x, _REGION) for x in table["regions"].to_pylist()])
    if len(r) and table["bucket"][0].as_py() < buckets:
        r = r[np.argsort(r["key"], kind="stable")]
        new = np.ones(len(r), bool)
        new[1:] = r["key"][1:] != r["key"][:-1]
        first = np.flatnonzero(new)
        places = np.add.reduceat(r["copies"].astype(np.int64), first)
        r = r[((np.repeat(places, np.diff(np.append(first, len(r)))) > 1) | (r["self"] > 0)) & (r["windows"] > 0)]
    return pa.table([pa.array(r["key"].astype(np.uint64).view(np.int64)),
                     pa.array(r["content"].astype(np.uint64).view(np.int64)), pa.array(r["text"].astype(np.int64)),
                     *[pa.array(r[c].astype(np.int64)) for c in ("at", "windows", "copies")], pa.array(r["self"] > 0)],
                    names=["key", "content", "text", "at", "windows", "copies", "self"])


class SuffixAutomaton:
    """Suffix automaton of several sequences; ``add`` returns the states of all prefixes of a sequence."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the substrings that ``p`` followed by ``c`` ends; returns it."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> list[int]:
        last, path = 0, []
        nxt, length, link = self.next, self.length, self.link
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new, p = self._state(length[last] + 1, 0, {}), last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            path.append(last)
        return path


def repeated_windows(sequences: list[list[int]], places: list[int], size: int) -> list[np.ndarray]:
    """For each sequence the window starts whose words have two places or more, each sequence counting ``places`` times."""
    automaton = SuffixAutomaton()
    paths = [automaton.add(s) for s in sequences]
    length, link = np.array(automaton.length), np.array(automaton.link)
    count = np.zeros(len(length), np.int64)
    for path, n in zip(paths, places):
        np.add.at(count, path, n)
    order = np.argsort(length, kind="stable")
    edges = np.searchsorted(length[order], np.arange(length.max() + 2))
    for n in range(len(edges) - 2, 0, -1):  # all states of one length at a time, longest first
        level = order[edges[n]:edges[n + 1]]
        np.add.at(count, link[level], count[level])
    holder = np.arange(len(length))             # the state that holds the suffix of ``size`` words
    for n in range(size, len(edges) - 1):
        level = order[edges[n]:edges[n + 1]]
        longer = level[length[link[level]] >= size]
        holder[longer] = holder[link[longer]]
    return [np.flatnonzero(count[holder[np.array(p[size - 1:], np.int64)]] > 1) if len(p) >= size else np.zeros(0, np.int64) for p in paths]


def _runs(starts: np.ndarray) -> list[dict]:
    """Runs ``[a, b)`` of neighbouring window starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    a, b = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + 1
    return [{"a": int(x), "b": int(y)} for x, y in zip(a, b)]


_RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _search_shard(table: pa.Table, size: int) -> pa.Table:
    """Runs of repeated windows of one shard's regions."""
    table = table.sort_by([("key", "ascending"), ("content", "ascending")])
    words = [np.frombuffer(x, "<u4").tolist() for x in table["words"].to_pylist()]
    found = repeated_windows(words, table["places"].to_pylist(), size)
    return pa.table([table["content"], table["key"], pa.array([_runs(x) for x in found], _RUNS)], names=["content", "key", "runs"])


def _extract(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The words (low 32 bits of their hashes) of the regions asked for in each text; a text met again is left out."""
    seen: set[int] = set()
    for batch in batches:
        names = batch.column("text").to_pylist()
        fresh = []
        for i, name in enumerate(names):
            if name not in seen:
                seen.add(name)
                fresh.append(i)
        asked = batch.column("asked").take(pa.array(fresh, pa.int64())).to_pylist()
        texts = batch.column("body").take(pa.array(fresh, pa.int64()))
        rows = []
        for lo, hi, data, offsets in text_slices(texts):
            starts, ends, first = find_words(data, offsets, NOT_SPACE)
            words = hash_spans(data, starts, ends).astype("<u4")
            for i in range(lo, hi):
                for r in asked[i]:
                    a = first[i - lo] + r["at"]
                    rows.append((r["key"], r["content"], r["places"], r["key_words"], words[a:a + r["windows"] + size - 1].tobytes()))
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())],
                                         names=["key", "content", "places", "key_words", "words"])


_WINDOW = np.dtype([("at", "<u4"), ("places", "<u4")])
_OWNER = np.dtype([("content", "<i8"), ("key", "<i8")])


def _single_windows(batches: Iterator[pa.RecordBatch], size: int, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """All windows of the regions, packed by bucket of their content."""
    serial = TaskContext.get().partitionId() << 32
    for batch in batches:
        words, offsets = string_buffers(batch.column("words"))
        words, bounds = words[offsets[0]:offsets[-1]].view("<u4"), (offsets - offsets[0]) // 4
        lo = 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, lo + exchange.MAX_DOCS, max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + exchange.MAX_PAIRS, "right")) - 1))
            first = bounds[lo:hi + 1]
            at = window_starts(first, size)
            number = np.searchsorted(first, at, "right") - 1
            extra, docs = np.zeros(len(at), _WINDOW), np.zeros(hi - lo, _OWNER)
            extra["at"], extra["places"] = at - first[number], batch.column("places").to_numpy()[lo:hi][number]
            docs["content"], docs["key"] = batch.column("content").to_numpy()[lo:hi], batch.column("key").to_numpy()[lo:hi]
            yield exchange.pack(serial, hash_windows(words, at, size), number, extra, docs.tobytes(), buckets, hot)
            serial += 1
            lo = hi


def _repeated_in_bucket(table: pa.Table) -> pa.Table:
    """For each batch the windows that have two places or more."""
    batches, docs = table["batch"].to_pylist(), table["docs"].to_pylist()
    keys, numbers, row, extra = exchange.unpack(table, _WINDOW)
    twice = np.ones(len(keys), bool)
    if len(keys) and not table["hot"][0].as_py():
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        places = np.where(numbers == exchange.MARK, 2, extra["places"]).astype(np.int64)
        total = np.repeat(np.add.reduceat(places[order], first), np.diff(np.append(first, len(keys))))
        twice[order] = total > 1
        twice &= numbers != exchange.MARK
    edges = np.searchsorted(row, np.arange(len(batches) + 1))
    out = []
    for i, batch in enumerate(batches):
        mine = np.flatnonzero(twice[edges[i]:edges[i + 1]]) + edges[i]
        if len(mine) or docs[i] is not None:
            out.append((batch, numbers[mine].tobytes(), extra["at"][mine].tobytes(), docs[i]))
    cols = list(zip(*out)) if out else [[]] * 4
    return pa.table([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["batch", "numbers", "at", "docs"])


def _runs_of_batch(table: pa.Table) -> pa.Table:
    """The runs of repeated windows of each region of one batch."""
    docs = np.frombuffer(b"".join(x for x in table["docs"].to_pylist() if x is not None), _OWNER)
    numbers = np.concatenate([np.frombuffer(x, "<u2") for x in table["numbers"].to_pylist()])
    at = np.concatenate([np.frombuffer(x, "<u4") for x in table["at"].to_pylist()]).astype(np.int64)
    order = np.lexsort((at, numbers))
    numbers, at = numbers[order], at[order]
    edges = np.searchsorted(numbers, np.arange(len(docs) + 1))
    runs = [_runs(at[edges[i]:edges[i + 1]]) for i in range(len(docs))]
    return pa.table([pa.array(docs["content"].astype(np.int64)), pa.array(docs["key"].astype(np.int64)), pa.array(runs, _RUNS)], names=["content", "key", "runs"])


def repeated_spans(docs: DataFrame, size: int, text: str = "text", shard_words: int = SHARD_WORDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """``(text_hash, spans)``: for each text with a repeated window, the word spans ``[a, b)`` of its repeated windows."""
    col = F.col
    texts = docs.select(F.xxhash64(text).alias("text"), col(f"`{text}`").cast("string").alias("body")).where("body is not null")
    buckets, often = exchange.dealing(texts, "body", bytes_per_byte=0.4)
    packed = texts.mapInArrow(lambda it: _emit(it, size, buckets, often), "bucket int, regions binary")
    entries = stored(packed.groupBy("bucket").applyInArrow(lambda t: _repeated(t, buckets), _ENTRY), "regions")
    # Places of one content; the same text met in several tasks adds up.
    contents = stored(entries.groupBy("key", "content").agg(
        F.sum("copies").alias("places"), F.max("self").alias("self"),
        F.min(F.struct("text", "at", "windows")).alias("one")), "contents")
    # Of the keys with several contents; stored, so that both sides of the join are scans and a hot key's rows can be split.
    key_words = F.sum(col("one.windows") + size - 1)
    keys = stored(contents.groupBy("key").agg(F.count("*").alias("contents"), key_words.alias("key_words")).where("contents > 1"), "keys")
    contents = contents.join(keys, "key", "left").withColumns({
        "contents": F.coalesce("contents", F.lit(1)), "key_words": F.coalesce("key_words", col("one.windows") + size - 1)})
    contents = stored(contents, "key-contents")
    settled = contents.where("places > 1").select("key", "content", F.array(F.struct(F.lit(0).cast("long").alias("a"), col("one.windows").alias("b"))).alias("runs"))
    asked = contents.where("(contents > 1 or self) and (places = 1 or contents > 1)")
    total = asked.agg(F.sum(col("one.windows") + size - 1)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    asked = asked.groupBy(col("one.text").alias("text")).agg(
        F.collect_list(F.struct("key", "content", "places", "key_words", col("one.at").alias("at"), col("one.windows").alias("windows"))).alias("asked"))
    # Stored, so that the rows of a text with many copies can be split.
    words = stored(asked, "asked").join(texts, "text").mapInArrow(lambda it: _extract(it, size), "key long, content long, places long, key_words long, words binary")
    words = stored(words.dropDuplicates(["key", "content"]), "region-words")
    cold = words.where(col("key_words") <= hot_words).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = cold.groupBy("shard").applyInArrow(lambda t: _search_shard(t, size), "content long, key long, runs array<struct<a:long,b:long>>")
    hot = words.where(col("key_words") > hot_words).select("key", "content", "places", "words")
    windows = hot.mapInArrow(lambda it: _single_windows(it, size, buckets, often), exchange.SCHEMA)
    hot_found = windows.groupBy("bucket").applyInArrow(_repeated_in_bucket, "batch long, numbers binary, at binary, docs binary") \
        .groupBy("batch").applyInArrow(_runs_of_batch, "content long, key long, runs array<struct<a:long,b:long>>")
    single = contents.where("places = 1").select("key", "content")
    found = found.unionByName(hot_found).join(single, ["key", "content"], "left_semi").where(F.size("runs") > 0)
    runs = stored(found.unionByName(settled), "runs")
    spans = entries.select("key", "content", "text", "at").distinct().join(runs, ["key", "content"]).select(
        "text", F.explode("runs").alias("r"), "at").select("text", F.struct((col("at") + col("r.a")).alias("a"), (col("at") + col("r.b") + size - 1).alias("b")).alias("s"))
    # Stored, so that the rows of a text with many copies can be split where they are joined with it.
    return stored(spans.groupBy(col("text").alias("text_hash")).agg(F.array_sort(F.collect_list("s")).alias("spans")), "spans")


def _remove(batches: Iterator[pa.RecordBatch], n_carried: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        spans = batch.column("__spans")
        for i, raw in enumerate(batch.column("__text").cast(pa.binary()).to_pylist()):
            words = (raw or b"").split()
            n = len(words)
            if spans[i].is_valid:
                out, end = [], 0
                for s in spans[i].as_py():
                    if s["b"] <= end:
                        continue
                    out += words[end:max(end, s["a"])]
                    end = s["b"]
                words = out + words[end:]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([*batch.columns[:n_carried], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                          pa.array(kept, pa.binary()).cast(pa.string())],
                                         names=[*batch.schema.names[:n_carried], "n_words", "n_removed", "kept"])


def remove_repeated(docs: DataFrame, size: int = 35, text: str = "text", keep: list[str] | None = None,
                    shard_words: int = SHARD_WORDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``n_words``, ``n_removed`` and ``kept``, the words that stay."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "n_removed", "kept")]
    spans = repeated_spans(docs, size, text, shard_words, hot_words).toDF("__hash", "__spans")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    rows = rows.join(spans.hint("shuffle_hash"), "__hash", "left").drop("__hash")
    fields = [f for f in rows.schema.fields if f.name not in ("__text", "__spans")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_words long, n_removed long, kept string"])
    rows = rows.select(*[F.col(f"`{f.name}`") for f in fields], "__text", "__spans")
    return rows.mapInArrow(lambda it: _remove(it, len(fields)), schema)
