"""Initial centers by k-means|| that do not move with partitions.

1. The first candidate is the row whose key has the least hash.
2. ``steps`` times, every row becomes a candidate with probability ``min(1, l d^2 / phi)``: ``d`` is its
   distance from the nearest candidate so far, ``phi`` the sum of ``d^2`` over all rows, ``l`` the oversampling
   (``2 k``).  The draw is a hash of the row's key, and ``phi`` is summed without rounding.
3. Each candidate weighs as many rows as it is the nearest of (the first of several).
4. Of the candidates, in order of step and key, ``k`` are drawn one by one: the first by weight, the next by
   weight times squared distance from those drawn, with hashes of the seed.

About ``1 + steps * l`` candidates come to the driver, however many rows there are; each step is one pass.  With fewer
candidates than ``k`` all of them are centers, so fewer than ``k`` come back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lodestar.functions.exact import exact_sums
from lodestar.functions.hashing import key_string, uniform
from lodestar.operators import vectors

STEPS = 2


def drawn(seed: int, salt: str) -> float:
    """A number in (0, 1) from the seed and a salt alone."""
    return (int(hashlib.md5(f"{seed}:{salt}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296.0


def _least_squared_distance(spark, vec: str, centers: list[list[float]]) -> Column:
    shared = spark.sparkContext.broadcast(np.array(centers, np.float64))

    @pandas_udf("double")
    def least(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = shared.value
        for v in batches:
            x, good = vectors._rows(v, c.shape[1])
            d = np.full(len(v), np.nan)
            if len(x):
                near = vectors.nearest(x, c)
                d[good] = vectors._in_order(x, c[near])
            yield pd.Series(d)

    return least(F.col(vec))


def reduced(candidates: Sequence[Sequence[float]], weights: Sequence[float], k: int, seed: int) -> list[int]:
    """Places of the ``k`` candidates drawn, in order of drawing (all of them if there are no more)."""
    x, w = np.array(candidates, np.float64), np.array(weights, np.float64)
    chosen: list[int] = []
    share = w.copy()
    for i in range(min(k, len(x))):
        total = np.cumsum(share)
        if not total[-1] > 0:
            break
        chosen.append(int(np.argmax(total > drawn(seed, f"reduce{i}") * total[-1])))
        d = np.array([min(float(((a - x[j]) * (a - x[j])).sum()) for j in chosen) for a in x])
        share = w * d
    return chosen


def parallel_centers(df: DataFrame, vec: str, key: Sequence[str], k: int, seed: int = 42, steps: int = STEPS, oversampling: float | None = None) -> list[list[float]]:
    """``k`` centers (fewer if the rows have fewer different points) for the array column ``vec``."""
    spark, l = df.sparkSession, float(oversampling or 2 * k)
    v = F.col(f"`{vec}`").cast("array<double>")
    rows = df.select(*key, v.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:first:"), key_string(key))), *key).limit(1).collect()
        candidates = [list(r["v"]) for r in first]
        if not candidates:
            return []
        for step in range(steps):
            far = rows.withColumn("d2", _least_squared_distance(spark, "v", candidates))
            phi = exact_sums(far, ["d2"])["d2"].total
            if not phi:
                break  # every row is a candidate's point
            p = F.least(F.lit(1.0), F.lit(l) * F.col("d2") / F.lit(float(phi)))
            some = far.where(uniform(key, seed, f"step{step}") < p).orderBy(*key).select("v").collect()
            candidates += [list(r["v"]) for r in some]
        sizes = {r["cluster"]: r["count"] for r in vectors.assigned(rows, "v", candidates).groupBy("cluster").count().collect()}
    finally:
        rows.unpersist()
    weights = [sizes.get(i, 0) for i in range(len(candidates))]
    return [candidates[i] for i in reduced(candidates, weights, k, seed)]
