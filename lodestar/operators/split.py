"""Train/validation splits.

* :func:`random_split`  -- Bernoulli split with a seed; reproducible with a
  key, otherwise the result depends on the input partitioning.
* :func:`hash_split`    -- reproducible: a row's side depends only on its key
  (first 32 bits of ``md5(key)`` modulo 100).  No shuffle.
* :func:`tail_split`    -- ordered: the first ``int(n * (1 - test_fraction))``
  rows by key are train, the rest validation.  Exact, without a global
  window: mergeable quantile sketches and counts narrow down the key at the cut,
  then every row is decided by one comparison with it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestar.functions.hashing import hash_bucket, key_string, uniform  # noqa: F401  (re-exported)
from lodestar.session import persisted, shared_dir

SKETCH = 4096           # size of the quantile sketch: some ten thousand numbers
SKETCH_ERROR = 0.002    # of its ranks, with room to spare (a bound that misses costs a round, no more)
DRAWN = 4096            # values drawn of a column that no sketch takes
LOOK = 16_384           # rows whose keys are looked at on the driver
CHUNK = 10_000          # equal rows that one task writes out again
SORTED = 500_000        # rows that a task of randomSplit sorts


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 42, key: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Bernoulli split.  With ``key`` a row's side is a hash of its key and the seed, so it does
    not move with the partitioning; without, it is Spark's ``randomSplit``, which does.

    ``randomSplit`` sorts each partition by all columns, for either side anew.  So ``df`` is written once to the shared
    folder, and if a partition could be long its rows are dealt by a hash to tasks of about ``SORTED`` rows."""
    if key:
        train = uniform(key, seed, "split") < F.lit(float(train_fraction))
        return df.filter(train), df.filter(~train)
    path = shared_dir(df.sparkSession, "random-split")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    tasks = math.ceil(df.count() / SORTED)
    if tasks > 1:
        hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
        df = df.repartition(tasks, *hashed)
    train, valid = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, valid


def hash_split(df: DataFrame, key: Sequence[str], train_fraction: float = 0.7,
               buckets: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rows whose bucket is below ``train_fraction * buckets`` are train."""
    cut = int(round(train_fraction * buckets))
    b = hash_bucket(key, buckets)
    return df.filter(b < cut), df.filter(b >= cut)


def with_hash_side(df: DataFrame, key: Sequence[str], train_fraction: float = 0.7,
                   buckets: int = 100) -> DataFrame:
    """Add ``bucket`` and ``is_train`` instead of splitting."""
    cut = int(round(train_fraction * buckets))
    return df.withColumn("bucket", hash_bucket(key, buckets)) \
             .withColumn("is_train", F.col("bucket") < F.lit(cut))


def _bound(key: Sequence[str], bound: tuple, types: Sequence) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(key, bound, types)])


def _sketched(c: Column, kind: T.DataType) -> tuple[Column, str] | None:
    """``c`` as a whole or floating number in the same order, and which sketch takes it; None for other types."""
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint"), "bigint"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast("double"), "double"
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint"), "bigint"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c), "bigint"
    return None


class _Column:
    """One key column within a range of rows: how many are null or NaN, and approximate quantiles of the others.

    Whole and floating numbers and times are summarised by a mergeable KLL sketch, which every
    task builds of its rows; of other types ``DRAWN`` random values are drawn.
    """

    def __init__(self, rng: DataFrame, name: str, n: int, seed: int):
        c, kind = F.col(f"`{name}`"), rng.schema[name].dataType
        sketched = _sketched(c, kind)
        self.x, numbers = sketched or (c, None)
        nan = F.isnan(self.x) if numbers == "double" else F.lit(False)
        self.valid, self.null, self.nan = c.isNotNull() & ~nan, c.isNull(), c.isNotNull() & nan
        aggs = [F.count_if(self.null).alias("nulls"), F.count_if(self.nan).alias("nans")]
        if numbers:
            agg = F.kll_sketch_agg_bigint if numbers == "bigint" else F.kll_sketch_agg_double
            aggs.append(agg(F.when(self.valid, self.x), F.lit(SKETCH)).alias("sketch"))
        row = rng.agg(*aggs).first()
        self.nulls, self.nans, self.numbers, self.spark = row["nulls"], row["nans"], numbers, rng.sparkSession
        self.count = n - self.nulls - self.nans
        if numbers:
            self.sketch, self.error = row["sketch"], SKETCH_ERROR
        else:
            drawn = rng.where(self.valid).sample(fraction=min(1.0, 4 * DRAWN / max(self.count, 1)), seed=seed).orderBy(F.rand(seed)).limit(DRAWN)
            self.drawn = sorted(r[0] for r in drawn.select(c).collect()) or [r[0] for r in rng.where(self.valid).select(c).limit(1).collect()]
            self.error, self.kind = 1.5 / math.sqrt(max(len(self.drawn), 1)), kind

    def quantiles(self, *shares: float) -> list:
        """A value of the column near each share of the sorted valid rows."""
        shares = [min(max(q, 0.0), 1.0) for q in shares]
        if not self.numbers:
            return [self.drawn[min(int(q * len(self.drawn)), len(self.drawn) - 1)] for q in shares]
        f = F.kll_sketch_get_quantile_bigint if self.numbers == "bigint" else F.kll_sketch_get_quantile_double
        one = self.spark.range(1).select(F.lit(bytes(self.sketch)).alias("s"))
        return list(one.select(*[f("s", F.lit(q)).alias(f"q{i}") for i, q in enumerate(shares)]).first())

    def bound(self, value) -> Column:
        return F.lit(value) if self.numbers else F.lit(value).cast(self.kind)


def find_cut(df: DataFrame, key: Sequence[str], rank: int, n: int, look: int = LOOK) -> tuple[tuple, int, int]:
    """``(K, before, copies)``: the key of the row at ``rank`` (from 1) in key order of the
    ``n`` rows, how many rows have a smaller key, and how many have this key.

    Keys compare column by column, a null before every value (``ORDER BY ... NULLS FIRST``), NaN
    last.  The leading column is settled first.  Every round summarises the column in the range
    of rows left (:class:`_Column`), takes two bounds just beside the rank from the summary, counts the rows up to
    each, and goes on with the rows between, until one value is left (then the next column
    follows, among the rows with that value) or at most ``look`` rows, whose keys are looked at.
    A round leaves about ``2 * SKETCH_ERROR`` of the rows.  Per round a sketch and five counts reach the driver.
    """
    rng, before, at, seed = df.select(*key), 0, [], 7
    for name in key:
        exact = False
        while True:
            if n <= look:
                rows = [tuple(r) for r in rng.orderBy(*[F.asc_nulls_first(c) for c in key]).collect()]
                same = lambda r: all(x == y or x != x and y != y for x, y in zip(r, rows[rank - before - 1]))  # noqa: E731, B023
                copies = [same(r) for r in rows]
                return rows[rank - before - 1], before + copies.index(True), sum(copies)
            seed += 1
            c, wanted = _Column(rng, name, n, seed), rank - before
            if wanted <= c.nulls:
                at, rng, n = [*at, None], rng.filter(c.null), c.nulls
                break
            if wanted > c.nulls + c.count:
                at, rng, before, n = [*at, math.nan], rng.filter(c.nan), before + c.nulls + c.count, c.nans
                break
            q = (wanted - c.nulls - 0.5) / c.count
            low, high = c.quantiles(q, q) if exact else c.quantiles(q - c.error, q + c.error)
            lo, hi = c.bound(low), c.bound(high)
            below, upto = rng.agg(F.count_if(c.valid & (c.x < lo)), F.count_if(c.valid & (c.x <= hi))).first()
            first, size, old = before + c.nulls, n, rng
            if wanted - c.nulls <= below:
                rng, before, n = old.filter(c.valid & (c.x < lo)), first, below
            elif wanted - c.nulls > upto:
                rng, before, n = old.filter(c.valid & (c.x > hi)), first + upto, c.count - upto
            else:
                rng, before, n = old.filter(c.valid & (c.x >= lo) & (c.x <= hi)), first + below, upto - below
                if low == high:
                    at.append(rng.select(name).first()[0])
                    break
            exact = 2 * n > size  # few values: one of them is a bound next, so the range shrinks
    return tuple(at), before, n


def with_tail_side(df: DataFrame, key: Sequence[str], test_fraction: float = 0.3,
                   look: int = LOOK, persist: bool = True) -> DataFrame:
    """Add ``is_train``: true for the first ``int(n * (1 - test_fraction))`` rows in ``key``
    order (nulls first).

    ``find_cut`` finds the key at the cut; rows with another key are decided by one comparison.
    Copies of that key are taken in the order of a hash of the whole row, by the same search;
    rows equal in all columns are interchangeable, so they are counted and written out
    again, so many of them as train.  No task ranks a range of rows and no step depends on
    how the rows are partitioned.

    With ``persist`` the key columns are kept (memory, spilling to disk) for the search
    only; nothing is left persisted.
    """
    if not 0.0 < test_fraction < 1.0:
        raise ValueError("test_fraction must be in (0, 1)")
    keys = df.select(*key)
    with persisted(keys) if persist else nullcontext(keys) as keys:
        n = keys.count()
        n_train = int(n * (1.0 - test_fraction))
        if n_train in (0, n):
            return df.withColumn("is_train", F.lit(n > 0 and n_train == n))
        cut, before, copies = find_cut(keys, key, n_train, n, look)
    k = F.struct(*[F.col(c) for c in key])
    at = _bound(key, cut, [df.schema[c].dataType for c in key])
    take = n_train - before
    if take == copies:
        return df.withColumn("is_train", k <= at)
    others = df.filter(k != at).withColumn("is_train", k < at)
    return others.unionByName(_split_copies(df.filter(k == at), take, copies, look))


def _split_copies(copies: DataFrame, take: int, n: int, look: int) -> DataFrame:
    """``is_train`` for exactly ``take`` (more than 0, not all) of the ``n`` rows."""
    cols = [F.col(f"`{c}`") for c in copies.columns]
    named = copies.withColumn("_h", F.xxhash64(*cols))
    (h,), before, same = find_cut(named, ["_h"], take, n, look)
    out = named.filter(F.col("_h") != h).withColumn("is_train", F.col("_h") < h).drop("_h")
    equal = named.filter(F.col("_h") == h).drop("_h")
    if before + same == take:
        return out.unionByName(equal.withColumn("is_train", F.lit(True)))
    # Rows that are the same in every column (two kinds of rows only if 64-bit hashes collide).
    kinds = equal.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    spread = kinds.withColumn("_end", F.sum("_n").over(Window.orderBy(*cols))) \
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / CHUNK)))) \
        .repartition(F.col("_part"))
    first = F.col("_part") * CHUNK + 1
    rows = spread.withColumn("_i", F.explode(F.sequence(first, F.least(F.col("_n"), first + CHUNK - 1))))
    rows = rows.withColumn("is_train", F.col("_end") - F.col("_n") + F.col("_i") <= take - before)
    return out.unionByName(rows.drop("_n", "_end", "_part", "_i"))


def tail_split(df: DataFrame, key: Sequence[str], test_fraction: float = 0.3,
               **kw) -> tuple[DataFrame, DataFrame]:
    """Ordered split: (first ``int(n*(1-test_fraction))`` rows by key, the rest)."""
    s = with_tail_side(df, key, test_fraction, **kw)
    return s.filter("is_train").drop("is_train"), s.filter(~F.col("is_train")).drop("is_train")
