"""Keys with many rows: which they are, and a join that spreads the rows of each over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT = 1_000_000   # keys whose ids and split counts are broadcast: about 64 MB


def threshold(sizes: DataFrame, size: str, floor: int, max_hot: int = MAX_HOT) -> tuple[int, int]:
    """``(t, n)``: ``n`` keys, at most ``max_hot``, have a ``size`` above ``t``, which is ``floor`` or, if more
    keys are above that, the least power of two that keeps to ``max_hot``.  The sizes are counted by
    powers of two, so at most 64 rows reach the driver.

    As the sizes of all keys add up to the number of rows, ``t`` is below twice the rows divided by ``max_hot``.
    """
    bits = F.length(F.bin(F.col(size) - 1))   # 2^(bits - 1) < size <= 2^bits, for sizes above 1
    above = F.col(size) > floor
    rows = sizes.filter(above).groupBy(F.when(F.col(size) > 1, bits).otherwise(0).alias("bits")).count().collect()
    t, n = floor, sum(r["count"] for r in rows)
    for p in range(64):
        if n <= max_hot:
            break
        if 2 ** p > floor:
            t, n = 2 ** p, sum(r["count"] for r in rows if r["bits"] > p)
    return t, n


def salts(hot: DataFrame, key: str, size: str, t: int, name: str) -> DataFrame:
    """``(name, salts)``: over how many tasks the rows of each hot key go, so that each gets about ``t``.
    For a broadcast: the caller's :func:`threshold` bounds the rows of ``hot``."""
    return F.broadcast(hot.select(F.col(key).alias(name), F.ceil(F.col(size) / max(t, 1)).cast("int").alias("salts")))


def salt_of(by: Column) -> Column:
    """Which of the ``salts`` of its key a row goes to (0 for other keys), by a hash of ``by``."""
    return F.coalesce(F.pmod(F.xxhash64(by), F.col("salts")).cast("int"), F.lit(0))


def all_salts() -> Column:
    """A row for each of the ``salts`` of its key (one for other keys)."""
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))


def salted_join(big: DataFrame, table: DataFrame, key: str, by: str, split: DataFrame | None) -> DataFrame:
    """``big JOIN table USING (key)``, ``table`` having one row per key.  The rows of a key in ``split``
    (:func:`salts`) are dealt by a hash of ``by``, and the key's row of ``table`` is repeated for
    each part; other keys are joined as they are."""
    if split is None:
        return big.join(table, key)
    left = big.join(split, key, "left").withColumn("salt", salt_of(F.col(by))).drop("salts")
    right = table.join(split, key, "left").withColumn("salt", all_salts()).drop("salts")
    return left.join(right, [key, "salt"]).drop("salt")
