"""Clustering of array columns: any number of centers and dimensions.

Points are one ``array<double>`` column.  Centers are a k by d matrix that is broadcast; a batch of
points meets it in blocks of centers by matrix products, so no center enters the plan as a literal and no
feature is a column.  New centers are vector sums per cluster, added up
within each task first (MLlib's ``Summarizer``), so a step shuffles at most k rows a task; k rows of d numbers come back.

Distances.  ``|x|^2 - 2 x.c + |c|^2`` of a product is rounded differently from a sum of squared differences,
so centers within a relative ``CLOSE`` of the least are compared by the latter, added up in order of the
dimensions; the lowest index wins a tie.

Triangle inequality.  A center whose distance from the center of a point's last cluster is at least
twice the point's distance from that one cannot be nearer.  With ``last``, the column of a former
assignment, points of a batch are taken by their last cluster and only the centers near enough for
any of them are multiplied.

A null vector, or one with a null or NaN, has no cluster (null) and is in no sum.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lodestar.functions.distance import allclose
from lodestar.operators.clustering import LloydResult

CLOSE = 1e-9
BLOCK = 1 << 20       # distances worked out at a time


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Of all pairs, by a matrix product."""
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * x @ centers.T + (centers * centers).sum(1), 0.0)


def _in_order(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sums of squared differences of pairs, dimension by dimension."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += (x[:, j] - c[:, j]) * (x[:, j] - c[:, j])
    return out


def nearest(x: np.ndarray, centers: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """The nearest center of each point (of those in ``among``, ascending); the lowest index on a tie."""
    among = np.arange(len(centers)) if among is None else among
    c = centers[among]
    scale = float((c * c).sum(1).max(initial=0.0))
    out = np.empty(len(x), np.int64)
    step = max(1, BLOCK // max(len(c), 1))
    for lo in range(0, len(x), step):
        some = x[lo:lo + step]
        d = squared_distances(some, c)
        best = d.argmin(1)
        least = d[np.arange(len(some)), best]
        close = d <= (least + CLOSE * (least + scale + (some * some).sum(1)))[:, None]
        rows = np.flatnonzero(close.sum(1) > 1)
        if len(rows):
            point, which = np.nonzero(close[rows])
            exact = _in_order(some[rows[point]], c[which])
            order = np.lexsort((which, exact, point))
            first = order[np.searchsorted(point[order], np.arange(len(rows)))]
            best[rows] = which[first]
        out[lo:lo + step] = among[best]
    return out


def nearest_from(x: np.ndarray, last: np.ndarray, centers: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """As ``nearest``, from each point's last cluster; ``apart``: squared distances between the centers (by a product, so with room for its rounding)."""
    out = np.empty(len(x), np.int64)
    room = CLOSE * float((centers * centers).sum(1).max(initial=0.0))
    order = np.argsort(last, kind="stable")
    edges = np.searchsorted(last[order], np.arange(len(centers) + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        rows = order[edges[i]:edges[i + 1]]
        away = ((x[rows] - centers[i]) ** 2).sum(1).max()
        out[rows] = nearest(x[rows], centers, np.flatnonzero(apart[i] <= 4.0 * away * (1 + CLOSE) + room))
    return out


def _rows(v: pd.Series, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The valid vectors as a matrix, and which they are."""
    good = np.array([x is not None and len(x) == d for x in v], bool)
    x = np.array(v[good].tolist(), np.float64).reshape(-1, d)
    finite = ~np.isnan(x).any(1)
    good[np.flatnonzero(good)[~finite]] = False
    return x[finite], good


def assigned(df: DataFrame, vec: str, centers: Sequence[Sequence[float]], out: str = "cluster", last: str | None = None) -> DataFrame:
    """Add ``out``, the index of the nearest center; ``last`` names the column of a former assignment to nearby centers."""
    matrix = np.array(centers, np.float64)
    apart = squared_distances(matrix, matrix) if last else None
    shared = df.sparkSession.sparkContext.broadcast((matrix, apart))

    @pandas_udf("int")
    def cluster(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m, between = shared.value
        for v, before in batches:
            x, good = _rows(v, m.shape[1])
            result = np.full(len(v), -1, np.int64)
            if len(x):
                start = before[good].fillna(-1).to_numpy().astype(np.int64)
                known = (start >= 0) & (start < len(m)) & (between is not None)
                found = np.empty(len(x), np.int64)
                if known.any():
                    found[known] = nearest_from(x[known], start[known], m, between)
                if not known.all():
                    found[~known] = nearest(x[~known], m)
                result[good] = found
            yield pd.Series(result).astype("Int32").where(pd.Series(result >= 0))

    return df.withColumn(out, cluster(F.col(f"`{vec}`").cast("array<double>"), F.col(f"`{last}`") if last else F.lit(None).cast("int")))


def vector_means(rows: DataFrame, vec: str, cluster: str = "cluster") -> DataFrame:
    """``(cluster, mean, n)`` of the clusters that have points; ``mean`` is an array."""
    v = array_to_vector(F.col(f"`{vec}`").cast("array<double>"))
    means = rows.where(F.col(cluster).isNotNull()).select(cluster, v.alias("_v")) \
        .groupBy(cluster).agg(Summarizer.metrics("mean", "count").summary(F.col("_v")).alias("_s"))
    return means.select(cluster, vector_to_array("_s.mean").alias("mean"), F.col("_s.count").alias("n"))


def vector_statistics(df: DataFrame, vec: str, ddof: int = 0) -> tuple[list[float], list[float]]:
    """Mean and standard deviation of every dimension, from one aggregate of vector sums (null vectors ignored)."""
    v = F.col(f"`{vec}`").cast("array<double>")
    row = df.where(v.isNotNull()).select(array_to_vector(v).alias("_v")).agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s")).first()["s"]
    n = row["count"]
    factor = 1.0 if ddof == 1 or n < 2 else (n - 1) / n   # the summarizer's variance is the sample's
    return list(map(float, row["mean"])), [float(np.sqrt(x * factor)) for x in row["variance"]]


def standardized(df: DataFrame, vec: str, mean: Sequence[float], std: Sequence[float], out: str | None = None) -> DataFrame:
    """The vectors less ``mean``, each dimension divided by its deviation (0 where that is 0)."""
    m, s = (F.lit(np.array(x, np.float64)) for x in (mean, std))
    centered = F.zip_with(F.col(f"`{vec}`").cast("array<double>"), m, lambda a, b: a - b)
    return df.withColumn(out or vec, F.zip_with(centered, s, lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)))


def first_vectors(df: DataFrame, vec: str, k: int, key: Sequence[str]) -> list[list[float]]:
    """The vectors of the first k rows by ``key``."""
    rows = df.where(F.col(f"`{vec}`").isNotNull()).orderBy(*key).limit(k).select(F.col(f"`{vec}`").cast("array<double>").alias("v")).collect()
    if len(rows) < k:
        raise ValueError(f"need at least {k} rows to pick initial centers, got {len(rows)}")
    return [list(r["v"]) for r in rows]


def lloyd(df: DataFrame, vec: str, k: int = 2, max_iters: int = 10, tol: float = 1e-5, key: Sequence[str] | None = None,
          init: Sequence[Sequence[float]] | None = None, prune: bool = False) -> LloydResult:
    """Lloyd's iteration on an array column; the rules of :func:`lodestar.operators.clustering.lloyd_kmeans`:
    first k rows by ``key`` (or ``init``), zero vector for a cluster without points, current centers returned when the new ones are all-close.

    ``prune`` assigns the points to their clusters once before the loop and keeps that column with the persisted points, for the triangle inequality.
    """
    if init is None and not key:
        raise ValueError("pass key= (an ordering for the first-k init) or init=")
    centers = [list(map(float, c)) for c in init] if init is not None else first_vectors(df, vec, k, key)
    points = df.select(F.col(f"`{vec}`").cast("array<double>").alias("v"))
    last = "last" if prune else None
    points = (assigned(points, "v", centers, "last") if prune else points).persist(StorageLevel.MEMORY_AND_DISK)
    times, converged, it = [], False, 0
    try:
        for it in range(1, max_iters + 1):
            start = time.time()
            found = {r["cluster"]: r["mean"] for r in vector_means(assigned(points, "v", centers, last=last), "v").collect()}
            new = [list(found[i]) if i in found else [0.0] * len(centers[0]) for i in range(len(centers))]
            times.append(time.time() - start)
            if allclose(centers, new, rtol=tol):
                converged = True
                break
            centers = new
    finally:
        points.unpersist()
    return LloydResult(centers, it, converged, times)


def centers_rows(spark, centers: Sequence[Sequence[float]]) -> DataFrame:
    """``(cluster, dimension, value)`` of the centers."""
    rows = [(i, j, float(x)) for i, c in enumerate(centers) for j, x in enumerate(c)]
    return spark.createDataFrame(rows, "cluster INT, dimension INT, value DOUBLE")
