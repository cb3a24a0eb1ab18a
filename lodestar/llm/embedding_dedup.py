"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. Equal vectors are one *class* with a count, combined before any shuffle.
2. Iterative quantisation: principal axes of a bounded sample of classes, then a
   rotation that is improved in turns with the binary codes it gives, so that
   the bits lose little of the geometry and split evenly.
3. Every class gets its code, and every table one key: the bits that the
   table's own choice of positions picks from the code.  Classes with one key in one
   table form a bucket.  Keys have about ``log2(classes) - 3`` bits, so a bucket
   holds some classes whatever the size of the data.  The tables of one rotation
   share no bits; when its bits are used up, another rotation is learnt.
   Only codes are dealt to the tables, not vectors.
4. A large bucket is cut into blocks of ``BLOCK`` classes and every pair of blocks is a task's group of
   its own.  Within a group, pairs are dropped that met in an earlier table (the codes tell) or whose
   whole codes differ in more bits than any probe at the threshold did; the classes that
   are left in some pair get their vectors, and the group's pairs are ranked again with these, by a
   matrix product in double precision.  Pairs do not leave the task: a pair is counted in the
   first table in which the two keys are equal, and only counts per class and the links of a
   spanning forest go out.
5. The forests make components.

The sample only fits the rotations; all vectors are coded and searched.  A pair
at the threshold meets in a table with probability about ``(1 - angle / pi) **
bits``, so longer keys need more tables.  Their number is measured, not taken from
that formula: pairs at just the threshold are made from the sample, in random
directions and towards other vectors, and tables are added until ``RECALL`` of
either kind meet (``tables`` at least).  Should that take more than
``MOST_TABLES``, keys get shorter instead, down to none, where all pairs meet:
buckets grow then, but no links are given up.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link, each
length has its own rotation; equal vectors link; rows with a null id count
as vectors and have the smallest id of their component; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from lodestar.llm.bytescan import mix
from lodestar.llm.components import components, stored

TABLES = 16         # at least
MOST_TABLES = 256   # with more, keys get shorter
RECALL = 0.95       # of pairs at the threshold
PROBES = 4000
KEYED_BYTES = 32 << 20
SAMPLE = 20_000
BLOCK = 1024
KEY_BITS = 48       # at most; the table is above them
TURNS = 50


def learn_rotation(sample: np.ndarray, turns: int = TURNS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (columns are bits) for unit vectors."""
    mean = sample.mean(0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x.T @ x)
    v = x @ axes.T
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(turns):
        b = np.where(v @ r > 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(b.T @ v)
        r = (u @ w).T
    return mean, axes.T @ r


def probes(sample: np.ndarray, threshold: float, seed: int = 17) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors whose cosine is the threshold: from vectors of the sample in random directions, and towards other vectors."""
    rng = np.random.default_rng(seed)
    t = min(max(threshold, -1.0), 1.0)
    out = []
    for towards in (None, sample):
        a = sample[rng.integers(0, len(sample), PROBES)]
        z = rng.standard_normal(a.shape) if towards is None else towards[rng.integers(0, len(towards), PROBES)]
        z = z - (z * a).sum(1, keepdims=True) * a
        length = np.linalg.norm(z, axis=1, keepdims=True)
        some = length[:, 0] > 1e-6  # not for copies of one direction
        if some.any():
            a, z = a[some], z[some] / length[some]
            out.append((a, t * a + np.sqrt(1 - t * t) * z))
    return out


def fit_tables(sample: np.ndarray, bits: int, threshold: float, least: int = TABLES, recall: float = RECALL,
               most: int = MOST_TABLES, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, rotations (columns are bits) and for each table the columns of its key, so many that ``recall`` of the probes meet."""
    width = sample.shape[1]
    pairs = probes(sample, threshold)
    mean, rotations, same = sample.mean(0), [], []

    def agreeing(r: int) -> list[np.ndarray]:
        """Which bits of rotation ``r`` agree, for the pairs of each kind."""
        if r == len(rotations):
            rotations.append(learn_rotation(sample, seed=7 + r)[1])
            same.append([((a - mean) @ rotations[r] > 0) == ((b - mean) @ rotations[r] > 0) for a, b in pairs])
        return same[r]

    agree = min((float(e.mean()) for e in agreeing(0)), default=1.0) if bits else 1.0
    while bits and (1 - agree ** bits) ** (most / 2) > 1 - recall:  # far too many tables
        bits -= 1
    for n in range(bits, 0, -1):
        met, positions = [np.zeros(len(a), bool) for a, _ in pairs], []
        rng = np.random.default_rng(seed)
        while len(positions) < most:
            r, k = divmod(len(positions), width // n)
            order = rng.permutation(width) if k == 0 else order
            chosen = order[k * n:(k + 1) * n]
            positions.append(r * width + chosen)
            for m, e in zip(met, agreeing(r)):
                m |= e[:, chosen].all(1)
            if len(positions) >= least and all(m.mean() >= recall for m in met):
                return mean, np.concatenate(rotations[:r + 1], 1), np.array(positions, np.int64)
    return mean, np.zeros((width, 0)), np.zeros((1, 0), np.int64)  # one table with one key


def keys_of(codes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The key of every code (rows of booleans) in every table."""
    weights = np.uint64(1) << np.arange(positions.shape[1], dtype=np.uint64)
    return np.stack([mix((codes[:, p] * weights).sum(1, dtype=np.uint64) + (np.uint64(t + 1) << np.uint64(KEY_BITS))) for t, p in enumerate(positions)], 1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def hamming_limit(sample: np.ndarray, fitted: tuple[np.ndarray, np.ndarray, np.ndarray], threshold: float) -> int:
    """The most bits in which the codes of a probe's two vectors differ (all bits if there are no probes)."""
    mean, rotation, _ = fitted
    most = [int((((a - mean) @ rotation > 0) != ((b - mean) @ rotation > 0)).sum(1).max()) for a, b in probes(sample, threshold)]
    return max(most) if most else rotation.shape[1]


def _keyed(batches: Iterator[pa.RecordBatch], fitted) -> Iterator[pa.RecordBatch]:
    """A row for each class and table: its key there, and its code (all bits)."""
    mean, rotation, positions = fitted.value[:3]
    tables = len(positions)
    for whole in batches:
        step = max(1, KEYED_BYTES // (tables * (rotation.shape[1] // 8 + 64)))
        for batch in (whole.slice(s, step) for s in range(0, whole.num_rows, step)):
            codes = (_unit(_matrix(batch.column("v"))) - mean) @ rotation > 0
            keys = keys_of(codes, positions)
            take = pa.array(np.repeat(np.arange(len(codes)), tables))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(tables), len(codes)), pa.int32()), batch.column("class").take(take),
                 pa.array([c.tobytes() for c in np.packbits(codes, 1)], pa.binary()).take(take)], names=["key", "table", "class", "code"])


def _bits(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    raw = column.to_pylist()
    return np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1, count=width).astype(bool)


def _not_met_before(near: np.ndarray, codes: np.ndarray, positions: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a symmetric boolean matrix whose keys differ in all tables before ``table``."""
    i, j = np.nonzero(np.triu(near))
    if table and len(i):
        for column in keys_of(codes, positions[:table]).T:
            apart = column[i] != column[j]
            i, j = i[apart], j[apart]
    return i, j


def _groups(table: pa.Table) -> Iterator[tuple[slice, bool, int]]:
    """Rows, whether of two blocks, and the hash table of each group of two rows or more."""
    group = np.stack([table[c].to_numpy() for c in ("key", "b1", "b2")], 1)
    bounds = np.append(np.flatnonzero(np.append(True, (group[1:] != group[:-1]).any(1))), len(group))
    tables = table["table"].to_numpy()
    for g in np.flatnonzero(np.diff(bounds) > 1).tolist():
        yield slice(bounds[g], bounds[g + 1]), bool(group[bounds[g]][1] != group[bounds[g]][2]), int(tables[bounds[g]])


_MEMBER = ["key", "table", "b1", "b2", "own", "class", "code"]


def _survivors(batches: Iterator[pa.RecordBatch], fitted) -> Iterator[pa.RecordBatch]:
    """The members of each group that are in a pair not met before with codes near enough."""
    _, rotation, positions, limit = fitted.value
    for table in whole_groups(batches, ["key", "b1", "b2"]):
        if not table.num_rows:
            continue
        codes, own, keep = _bits(table["code"], rotation.shape[1]), table["own"].to_numpy(), np.zeros(table.num_rows, bool)
        for s, across, t in _groups(table):
            x = codes[s].astype(np.float32)
            ones = x.sum(1)
            near = ones[:, None] + ones[None, :] - 2 * x @ x.T <= limit
            np.fill_diagonal(near, False)
            if across:
                near &= own[s][:, None] != own[s][None, :]  # two blocks: only pairs across
            for side in _not_met_before(near, codes[s], positions, t):
                keep[s.start + side] = True
        if keep.any():
            yield from table.filter(pa.array(keep)).select(_MEMBER).combine_chunks().to_batches()


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that keep the components of a symmetric boolean matrix."""
    left, edges = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if not left[i]:
            continue
        left[i], todo = False, [i]
        while todo:
            near = np.flatnonzero(linked[todo.pop()] & left)
            left[near] = False
            edges += [(i, int(j)) for j in near]
            todo += near.tolist()
    return edges


def whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``columns``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(c).to_numpy() for c in columns]
        same = np.ones(batch.num_rows, bool)  # as the last row
        for c in codes:
            same &= c == c[-1]
        cut = batch.num_rows if not same.any() else int(np.argmax(same))
        if held and cut == 0 and all(held[-1].column(c)[-1].as_py() == batch.column(c)[0].as_py() for c in columns):
            held.append(batch)
            continue
        held.append(batch.slice(0, cut))
        yield pa.Table.from_batches([h for h in held if h.num_rows] or [batch.slice(0, 0)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _link_groups(batches: Iterator[pa.RecordBatch], threshold: float, fitted) -> Iterator[pa.RecordBatch]:
    """Per class its number of links found here, and links that keep the components."""
    _, rotation, positions = fitted.value[:3]
    for table in whole_groups(batches, ["key", "b1", "b2"]):
        if not table.num_rows:
            continue
        names, copies, own = (table[c].to_numpy() for c in ("class", "copies", "own"))
        v, codes = _matrix(table["v"].combine_chunks()), _bits(table["code"], rotation.shape[1])
        counted: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for s, across, t in _groups(table):
            x = _unit(v[s])
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if across:
                near &= own[s][:, None] != own[s][None, :]
            i, j = _not_met_before(near, codes[s], positions, t)
            if not len(i):
                continue
            n, c = names[s], copies[s]
            sums = np.bincount(i, c[j], len(x)) + np.bincount(j, c[i], len(x))
            for a in np.flatnonzero(sums).tolist():
                counted[int(n[a])] = counted.get(int(n[a]), 0) + int(sums[a])
            first = np.zeros_like(near)
            first[i, j] = first[j, i] = True
            edges += [(int(n[a]), int(n[b])) for a, b in _forest(first)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counted, *[a for a, _ in edges]], pa.int64()), pa.array([None] * len(counted) + [b for _, b in edges], pa.int64()),
             pa.array([*counted.values(), *[0] * len(edges)], pa.int64())], names=["a", "b", "links"])


def _links_of_length(classes: DataFrame, n: int, threshold: float, tables: int, sample: int, block: int, kind: str) -> DataFrame:
    """``(a, b, links)`` rows for classes of one vector length."""
    spark = classes.sparkSession
    rows = classes.orderBy("class").limit(sample).select("v").collect()
    x = _unit(np.array([r["v"] for r in rows], np.float64))
    bits = int(min(x.shape[1], KEY_BITS, max(0, np.ceil(np.log2(n)) - 3)))
    found = fit_tables(x, bits, threshold, tables)
    fitted = spark.sparkContext.broadcast((*found, hamming_limit(x, found, threshold)))
    keyed = stored(classes.select("class", "v").mapInArrow(lambda it: _keyed(it, fitted), "key long, table int, class long, code binary"), "keyed")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("class", "table"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    parts = parts.withColumn("other", other).withColumns({"b1": F.least("own", "other"), "b2": F.greatest("own", "other")}).select(*_MEMBER)
    in_groups = lambda df: df.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2")
    members = stored(in_groups(parts).mapInArrow(lambda it: _survivors(it, fitted), "key long, table int, b1 int, b2 int, own int, class long, code binary"), "members")
    vectors = classes.select("class", "copies", F.col("v").cast(kind).alias("v"))  # as many bytes as the input has
    return in_groups(members.join(vectors, "class")).mapInArrow(lambda it: _link_groups(it, threshold, fitted), "a long, b long, links long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding",
                 tables: int = TABLES, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``vectors`` without the vector, with ``n_links``, ``component_id`` and ``kept``; columns of these names are replaced."""
    own = [c for c in vectors.columns if c not in (vector, "n_links", "component_id", "kept")]
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    valid = F.coalesce((F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda e: e != 0), F.lit(False))
    base = vectors.select(*[F.col(f"`{c}`") for c in own], F.when(valid, v).alias("__v"))
    base = base.withColumn("__class", F.when(F.col("__v").isNotNull(), F.xxhash64(F.transform("__v", lambda e: e + F.lit(0.0)))))
    classes = stored(base.where("__v is not null").groupBy(F.col("__class").alias("class")).agg(
        F.count("*").alias("copies"), F.first("__v").alias("v")), "vector-classes")
    kind = vectors.schema[vector].dataType
    width = "array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>"
    links = None
    for length, n in sorted(classes.groupBy(F.size("v")).count().collect()):
        found = _links_of_length(classes.where(F.size("v") == length), n, threshold, tables, sample, block, width)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = vectors.sparkSession.createDataFrame([], "a long, b long, links long")
    links = stored(links, "vector-links")
    counts = links.where("b is null").groupBy("a").agg(F.sum("links").alias("n"))
    parts = components(links.where("b is not null").select("a", "b"))
    known = classes.select("class", "copies").join(counts, F.col("class") == F.col("a"), "left").join(parts, F.col("class") == F.col("node"), "left")
    known = known.select(F.col("class").alias("__class"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "class").alias("__part"))
    rows = base.drop("__v").join(known, "__class", "left")
    lowest = rows.where("__part is not null").groupBy("__part").agg(F.min(f"`{vec_id}`").alias("__lowest"))
    out = rows.join(lowest, "__part", "left")
    component = F.coalesce("__lowest", f"`{vec_id}`")
    return out.select(*[F.col(f"`{c}`") for c in own], F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col(f"`{vec_id}`") == component, F.lit(False)).alias("kept"))
