"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

Two documents link when the Jaccard similarity of their sets of word n-grams is
at least ``threshold`` (in percent).  The product of the incidence matrix with
its transpose holds all overlaps; these steps compute the entries that bounds
from the sizes leave, and no other.

1. Documents of the same set are one *node* (named by a 64-bit hash of the set).
2. Columns in blocks: pairs (node, n-gram) are dealt by n-gram hash
   (``exchange``); a block drops the n-grams of one document, which add to no
   overlap, and returns the others with their document frequency.
3. Rows: a node with ``s`` shared of ``n`` n-grams overlaps nobody in more than
   ``s``, so it is dropped if ``s < threshold * n``.  The rest keep their shared
   n-grams in one order for all, rare ones first.
4. Two linked sets meet in their first ``n - ceil(threshold * n) + 1`` n-grams.  For
   each such n-gram the node with the best bound is the pivot, and every other
   node's entry with the pivot is computed, unless sizes and positions bound it
   below the threshold.
5. The links found make components.  The entries left are those between
   nodes of different components that meet in some n-gram: per n-gram, nodes outside
   its largest component against the others, under the same bounds.  Pairs
   inside a component need no further entry, so a group of near copies never
   becomes all its pairs, and no link between components is lost.

The largest groups are handled by joins on the n-gram whose skew adaptive execution
splits; nothing is broadcast without a measured size, nothing is collected.
Documents must be read from stored files (see ``exchange``).

Defined results: null and empty texts (and texts of white space) have no n-grams,
link with nothing and are their own component; a text of fewer words than an
n-gram has its whole word sequence as the only one; equal sets link, so all copies
of a text are in one component; rows of one doc_id are documents of their own
with equal ids; rows with a null id have their component's smallest other id
(null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm import exchange
from lodestar.llm.bytescan import NOT_SPACE, find_words, hash_spans, hash_windows, lower_ascii, mix, text_slices, window_starts
from lodestar.llm.components import components, stored

_DOCS = np.dtype([("node", "<u8"), ("n", "<u4")])
SEEN = 1_000_000


def ngram_sets(column, size: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """For runs of texts: the node of each text, and its ascending distinct n-gram hashes (empty sets have node 0)."""
    for _, _, data, offsets in text_slices(column):
        starts, ends, first = find_words(data := lower_ascii(data), offsets, NOT_SPACE)
        words = hash_spans(data, starts, ends)
        at = window_starts(first, size)
        grams = hash_windows(words, at, size)
        n_words = np.diff(first)
        short = (n_words > 0) & (n_words < size)
        whole = hash_spans(words, first[:-1][short], first[1:][short])
        bounds = np.concatenate([[0], np.cumsum(np.maximum(n_words - (size - 1), 0))])
        sets, k = [], 0
        for i in range(len(n_words)):
            if short[i]:
                sets.append(whole[k:k + 1])
                k += 1
            else:
                g = np.sort(grams[bounds[i]:bounds[i + 1]])
                sets.append(g[np.append(True, g[1:] != g[:-1])] if len(g) else g)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D)))]) if sets else np.zeros(1, np.uint64)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        node = mix(total[edge[1:]] - total[edge[:-1]] + sizes.astype(np.uint64))
        node[sizes == 0] = 0
        yield node, sets


def _signatures(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes = [np.zeros(0, np.uint64)], []
        for node, sets in ngram_sets(batch.column("__text"), size):
            nodes.append(node)
            sizes += map(len, sets)
        rest = batch.drop_columns(["__text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(np.concatenate(nodes).view(np.int64)), pa.array(sizes, pa.int64())],
                                         names=[*rest.schema.names, "__node", "__n"])


def _pairs(batches: Iterator[pa.RecordBatch], size: int, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Every node's n-grams, by bucket; a node met again in this task is not sent again."""
    serial = TaskContext.get().partitionId() << 32
    seen: set[int] = set()
    nodes, sets, pairs = [], [], 0

    def send() -> pa.RecordBatch:
        nonlocal serial, pairs
        docs = np.zeros(len(nodes), _DOCS)
        docs["node"], docs["n"] = nodes, [len(s) for s in sets]
        out = exchange.pack(serial, np.concatenate(sets), np.repeat(np.arange(len(sets)), docs["n"]), None, docs.tobytes(), buckets, hot)
        serial += 1
        pairs = 0
        nodes.clear()
        sets.clear()
        return out

    for batch in batches:
        for node, found in ngram_sets(batch.column(0), size):
            for name, grams in zip(node.tolist(), found):
                if not len(grams) or name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                nodes.append(name)
                sets.append(grams)
                pairs += len(grams)
                if pairs >= exchange.MAX_PAIRS or len(nodes) >= exchange.MAX_DOCS:
                    yield send()
    if nodes:
        yield send()


_SHARED = "batch long, keys binary, numbers binary, frequency binary, docs binary"


def _shared_rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                    names=["batch", "keys", "numbers", "frequency", "docs"])


def _shared(table: pa.Table) -> pa.Table:
    """One block of columns: the n-grams of two or more nodes, with a frequency that is the same for all holders."""
    batches, docs = table["batch"].to_pylist(), table["docs"].to_pylist()
    keys, numbers, row, _ = exchange.unpack(table)
    if table["hot"][0].as_py():  # common in their batch, so common
        frequency = np.full(len(keys), 0xFFFF, "<u2")
        keep = np.ones(len(keys), bool)
    else:
        order = np.argsort(keys, kind="stable")
        keys, numbers, row = keys[order], numbers[order], row[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(keys)))
        marked = np.add.reduceat((numbers == exchange.MARK).astype(np.int64), first) > 0 if len(keys) else np.zeros(0, bool)
        frequency = np.repeat(np.where(marked, 0xFFFF, np.minimum(count, 0xFFFE)), count).astype("<u2")
        keep = (frequency > 1) & (numbers != exchange.MARK)
    keys, numbers, row, frequency = keys[keep], numbers[keep], row[keep], frequency[keep]
    order = np.argsort(row, kind="stable")
    keys, numbers, frequency = keys[order], numbers[order], frequency[order]
    bounds = np.searchsorted(row[order], np.arange(len(batches) + 1))
    out = []
    for i, batch in enumerate(batches):
        s = slice(bounds[i], bounds[i + 1])
        if bounds[i + 1] > bounds[i] or docs[i] is not None:
            out.append((batch, exchange.to_planes(keys[s]), numbers[s].tobytes(), frequency[s].tobytes(), docs[i]))
    return _shared_rows(out)


def _rows_left(table: pa.Table, threshold: int) -> pa.Table:
    """One batch: its nodes that can reach the threshold, with their shared n-grams, rare ones first."""
    docs = np.frombuffer(b"".join(x for x in table["docs"].to_pylist() if x is not None), _DOCS)
    keys = np.concatenate([exchange.from_planes(x) for x in table["keys"].to_pylist()])
    numbers = np.concatenate([np.frombuffer(x, "<u2") for x in table["numbers"].to_pylist()])
    frequency = np.concatenate([np.frombuffer(x, "<u2") for x in table["frequency"].to_pylist()])
    shared = np.bincount(numbers, minlength=len(docs))
    left = shared * 100 >= threshold * docs["n"].astype(np.int64)
    keep = left[numbers]
    keys, numbers, frequency = keys[keep], numbers[keep], frequency[keep]
    order = np.lexsort((keys, frequency, numbers))
    ends = np.concatenate([[0], np.cumsum(shared[left])])
    grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[order].view(np.int64)))
    return pa.table([pa.array(docs["node"][left].view(np.int64)), pa.array(docs["n"][left], pa.int64()), grams], names=["node", "n", "grams"])


def candidate_rows(docs: DataFrame, text: str, size: int, threshold: int) -> DataFrame:
    """``(node, n, grams)``: the nodes that steps 2 and 3 leave, each once."""
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("t"))
    buckets, hot = exchange.dealing(texts, "t", bytes_per_byte=1.3)
    pairs = texts.mapInArrow(lambda it: _pairs(it, size, buckets, hot), exchange.SCHEMA)
    shared = pairs.groupBy("bucket").applyInArrow(_shared, _SHARED)
    rows = shared.groupBy("batch").applyInArrow(lambda t: _rows_left(t, threshold), "node long, n long, grams array<long>")
    return stored(rows.dropDuplicates(["node"]), "candidate-rows")


def _possible(threshold: int, n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Whether sets of these sizes whose first common n-gram stands at these places can reach the threshold."""
    return (100 * F.least(n1, n2) >= threshold * F.greatest(n1, n2)) & ((100 + threshold) * F.least(n1 - p1, n2 - p2) >= threshold * (n1 + n2))


def _entries(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(x, y)`` whose overlap, the product of their rows, reaches the threshold."""
    x, y = rows.toDF("x", "x_n", "x_grams"), rows.toDF("y", "y_n", "y_grams")
    both = pairs.join(x, "x").join(y, "y").select("x", "y", "x_n", "y_n", F.size(F.array_intersect("x_grams", "y_grams")).alias("overlap"))
    return both.where(100 * F.col("overlap") >= threshold * (F.col("x_n") + F.col("y_n") - F.col("overlap"))).select("x", "y")


def linked_components(rows: DataFrame, threshold: int) -> DataFrame:
    """``(node, component)`` of all nodes with a link, from the rows of ``candidate_rows``."""
    col = F.col
    left_out = col("n") - F.size("grams")
    prefix = col("n") - F.floor((threshold * col("n") + 99) / 100) + 1
    heads = rows.select("node", "n", left_out.alias("skip"), F.posexplode(F.slice("grams", F.lit(1), F.greatest(prefix - left_out, F.lit(0)).cast("int"))).alias("k", "g"))
    heads = stored(heads.select("g", "node", "n", (col("skip") + col("k")).alias("p")), "heads")
    pivots = heads.groupBy("g").agg(F.min(F.struct("p", "node", "n")).alias("pivot"), F.count("*").alias("c")).where("c > 1").drop("c")
    met = heads.join(pivots, "g").where(col("node") != col("pivot.node")) \
        .where(_possible(threshold, col("n"), col("p"), col("pivot.n"), col("pivot.p")))
    tried = stored(met.select(F.least("node", "pivot.node").alias("x"), F.greatest("node", "pivot.node").alias("y")).distinct(), "tried")
    links = stored(_entries(tried, rows, threshold), "found")
    parts = stored(components(links), "parts")
    # The entries between components.
    named = heads.join(parts, "node", "left").select("g", "node", "n", "p", F.coalesce("component", "node").alias("part"))
    sizes = named.groupBy("g", "part").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("g").agg(F.max(F.struct("c", "part")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    named = stored(named.join(mixed, "g").select("g", "node", "n", "p", "part", col("top.part").alias("top")), "mixed")
    few = named.where("part <> top").select("g", *[col(c).alias(f"{c}_1") for c in ("node", "n", "p", "part")])
    across = few.join(named, "g").where(col("part") != col("part_1")).where((col("part") == col("top")) | (col("node_1") < col("node"))) \
        .where(_possible(threshold, col("n_1"), col("p_1"), col("n"), col("p")))
    across = across.select(F.least("node", "node_1").alias("x"), F.greatest("node", "node_1").alias("y")).distinct().join(tried, ["x", "y"], "left_anti")
    more = stored(_entries(across, rows, threshold), "found")
    if not more.limit(1).count():
        return parts
    return components(links.unionByName(more))


def ngram_components(docs: DataFrame, size: int = 4, threshold: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_shingles``, ``component_id`` (the smallest doc_id that links reach) and
    ``component`` (one number for each component; null without n-grams).  Columns of these names are replaced.
    """
    docs = docs.drop("n_shingles", "component_id", "component")
    parts = linked_components(candidate_rows(docs, text, size, threshold), threshold)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text] + ["__node long, __n long"])
    carried = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col(f"`{text}`").cast("string").alias("__text"))
    named = stored(carried.mapInArrow(lambda it: _signatures(it, size), schema), "signatures")
    named = named.join(parts.toDF("__node", "__part"), "__node", "left").withColumn("__part", F.coalesce("__part", "__node"))
    # Stored, so that both sides of the join are plain shuffles and a large component's rows can be split.
    lowest = named.where("__n > 0").groupBy("__part").agg(F.min(f"`{doc_id}`").alias("__lowest"), F.count("*").alias("__rows"))
    lowest = stored(lowest.where("__rows > 1").drop("__rows"), "lowest")
    out = named.join(lowest, "__part", "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col("__n").alias("n_shingles"),
                      F.coalesce(F.when(F.col("__n") > 0, F.col("__lowest")), F.col(f"`{doc_id}`")).alias("component_id"),
                      F.when(F.col("__n") > 0, F.col("__part")).alias("component"))


def one_of_each(docs: DataFrame, size: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component (the first by doc_id, then by a hash of the text) and all rows without n-grams; columns as they were."""
    key = F.struct(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    found = ngram_components(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), key["hash"].alias("hash"), F.col(f"`{text}`").alias("text")), size, threshold)
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").alias("id"), "hash")).alias("key"))
    empty = found.where("component is null").select(F.struct(F.col("doc_id").alias("id"), "hash").alias("key"), F.lit(False).alias("one")).distinct()
    keys = first.select("key", F.lit(True).alias("one")).unionByName(empty)
    keys = keys.select(F.coalesce(F.col("key.id").cast("string"), F.lit("null")).alias("__id"), F.col("key.hash").alias("__hash"), F.col("one").alias("__one"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")).alias("__id"),
                       key["hash"].alias("__hash")).join(keys.hint("shuffle_hash"), ["__id", "__hash"])
    # Rows that repeat a chosen row in id and text; they lie in one partition after the join.
    chosen = rows.where("__one").groupBy("__id", "__hash").agg(F.first("__row").alias("__row")).select("__row")
    return chosen.unionByName(rows.where("not __one").select("__row")).select("__row.*")
