"""Clustering: MLlib k-means and a deterministic Lloyd iteration.

Lloyd's loop keeps the centers (k x d numbers) on the driver and puts them
into the plan as literals, so every iteration is one pass over the cached
points: assign (a column expression) and a ``groupBy(cluster)`` whose partial
aggregation leaves at most k rows per task.  At most k rows come back per
iteration; nothing proportional to the data reaches the driver, and the
lineage does not grow with the iteration count.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.distance import allclose, nearest_center


def assign_nearest(df: DataFrame, cols: Sequence[str] | str, centers: Sequence[Sequence[float]],
                   out: str = "cluster") -> DataFrame:
    """Add ``out`` = index of the nearest center (lowest index on a tie).

    ``cols``: the feature columns, or the name of one array column (wide vectors)."""
    return df.withColumn(out, nearest_center(cols, centers))


def valid_points(df: DataFrame, cols: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """``df`` without points that have a null or NaN feature (``"skip"``), or an
    error that says how many there are (``"error"``)."""
    if handle_invalid not in ("error", "skip"):
        raise ValueError("handle_invalid must be 'error' or 'skip'")
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    if handle_invalid == "skip":
        return df.filter(~bad)
    n = df.filter(bad).count()
    if n:
        raise ValueError(f"{n} points have a null or NaN in {', '.join(cols)}; handle_invalid='skip' leaves them out")
    return df


def cluster_means(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """``(cluster, mean of each column, n)`` for the clusters that have points."""
    return assigned.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols],
                                         F.count(F.lit(1)).alias("n"))


def update_centers(assigned: DataFrame, cols: Sequence[str], k: int,
                   cluster: str = "cluster") -> list[list[float]]:
    """New centers = mean of the points assigned to each cluster; a cluster
    with no point gets the zero vector.  Collects at most k rows."""
    rows = {r[cluster]: r for r in cluster_means(assigned, cols, cluster).collect()}
    return [[float(rows[i][c]) for c in cols] if i in rows else [0.0] * len(cols)
            for i in range(k)]


def update_centers_frame(assigned: DataFrame, cols: Sequence[str], k: int,
                         cluster: str = "cluster") -> DataFrame:
    """Lazy form of :func:`update_centers`: ``(cluster, cols..., n)`` with one
    row per index ``0..k-1``; an empty cluster has zeros and ``n = 0``."""
    spark = assigned.sparkSession
    ids = spark.range(k).select(F.col("id").cast("int").alias(cluster))
    means = cluster_means(assigned, cols, cluster)
    j = ids.join(F.broadcast(means), cluster, "left")  # both sides have <= k rows
    return j.select(cluster, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols],
                    F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def first_k(df: DataFrame, cols: Sequence[str], k: int, key: Sequence[str]) -> list[list[float]]:
    """The first k rows by ``key`` as initial centers (a top-k, no sort of
    the whole input)."""
    rows = df.orderBy(*key).limit(k).select(*cols).collect()
    if len(rows) < k:
        raise ValueError(f"need at least {k} rows to pick initial centers, got {len(rows)}")
    return [[float(r[c]) for c in cols] for r in rows]


@dataclass
class LloydResult:
    centers: list[list[float]]
    iterations: int
    converged: bool
    iteration_seconds: list[float] = field(default_factory=list)


def lloyd_kmeans(df: DataFrame, cols: Sequence[str], k: int = 2, max_iters: int = 10,
                 tol: float = 1e-5, key: Sequence[str] | None = None,
                 init: Sequence[Sequence[float]] | None = None, cache: bool = True,
                 handle_invalid: str = "error") -> LloydResult:
    """Lloyd's k-means on double columns.

    * init: ``init`` if given, else the first k rows ordered by ``key``;
    * each iteration assigns every point to its nearest center and moves
      each center to the mean of its points (zero vector if it has none);
    * stops after ``max_iters`` or when the new centers are all-close to the
      current ones (``rtol=tol``).  On that stop the *current* centers are
      returned, not the new ones;
    * ``handle_invalid``: see :func:`valid_points`.
    """
    df = valid_points(df, cols, handle_invalid)
    if init is None:
        if not key:
            raise ValueError("pass key= (an ordering for the first-k init) or init=")
        centers = first_k(df, cols, k, key)
    else:
        centers = [[float(x) for x in c] for c in init]
    pts = df.select(*cols)
    if cache:
        pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
    times, converged, it = [], False, 0
    try:
        for it in range(1, max_iters + 1):
            t0 = time.time()
            new = update_centers(assign_nearest(pts, cols, centers), cols, k)
            times.append(time.time() - t0)
            if allclose(centers, new, rtol=tol):
                converged = True
                break
            centers = new
    finally:
        if cache:
            pts.unpersist()
    return LloydResult(centers, it, converged, times)


def lloyd_standardized(df: DataFrame, cols: Sequence[str], key: Sequence[str], k: int = 2,
                       max_iters: int = 10, tol: float = 1e-5, ddof: int = 0,
                       digits: int | None = 12, handle_invalid: str = "error") -> tuple[LloydResult, list, list]:
    """The whole Lloyd workload: standardize (mean, ``ddof`` std), cluster
    with first-k init by ``key``, count cluster sizes with the returned
    centers.  The projected raw points are persisted once; the statistics
    pass fills the cache and every later pass (init, iterations, sizes)
    reads it, standardizing on the fly.  Returns ``(result, sizes, stats)``
    with ``sizes`` as ``[(cluster, n)]`` (k rows)."""
    from lodestar.operators.features import apply_standardizer, fit_standardizer
    from lodestar.session import persisted
    with persisted(df.select(*key, *cols)) as pts:
        pts = valid_points(pts, cols, handle_invalid)
        stats = fit_standardizer(pts, cols, ddof, digits)
        scaled = apply_standardizer(pts, cols, stats)
        res = lloyd_kmeans(scaled, cols, k=k, max_iters=max_iters, tol=tol, key=key, cache=False, handle_invalid="skip")
        sizes = [(int(r["cluster"]), int(r["n"])) for r in cluster_sizes(scaled, cols, res.centers).collect()]
    return res, sizes, stats


def cluster_sizes(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]],
                  cluster: str = "cluster") -> DataFrame:
    """``(cluster, n)`` ordered by cluster, from assigning with ``centers``."""
    return (assign_nearest(df, cols, centers, cluster)
            .groupBy(cluster).agg(F.count(F.lit(1)).alias("n")).orderBy(cluster))


def centers_frame(spark, centers: Sequence[Sequence[float]], cols: Sequence[str],
                  cluster: str = "cluster") -> DataFrame:
    """k x d centers as a small DataFrame ``(cluster, cols...)``."""
    schema = T.StructType([T.StructField(cluster, T.IntegerType(), False)]
                          + [T.StructField(c, T.DoubleType(), False) for c in cols])
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centers)], schema)


# ---- MLlib k-means ---------------------------------------------------------

def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int = 2, max_iter: int = 3, seed: int = 42,
               init_mode: str = "k-means||", with_mean: bool = True, with_std: bool = True,
               handle_invalid: str = "error", scaler: PipelineModel | None = None,
               scaled: DataFrame | None = None) -> PipelineModel:
    """Assemble -> standardize (sample std) -> MLlib ``KMeans``.  Results
    depend on the input partitioning (k-means|| sampling), so compare them by
    invariants, not by value.  The input columns are persisted for the fit
    (scaler statistics, k-means|| init and every iteration read them).

    ``scaler``: a fitted :func:`features.scaler_pipeline` to use, with ``scaled`` its output."""
    from lodestar.operators.features import scaler_pipeline
    from lodestar.session import persisted
    means = KMeans(k=k, maxIter=max_iter, seed=seed, initMode=init_mode, featuresCol="features", predictionCol="prediction")
    if scaler is not None:
        with persisted(scaled.select("features")) as pts:
            return PipelineModel([*scaler.stages, means.fit(pts)])
    with persisted(df.select(*cols)) as pts:
        scaler = scaler_pipeline(cols, with_mean, with_std, handle_invalid=handle_invalid)
        return Pipeline(stages=[*scaler.getStages(), means]).fit(pts)


def kmeans_centers(model: PipelineModel, cols: Sequence[str]) -> list[list[float]]:
    """Centers of a fitted :func:`fit_kmeans` model, in scaled space."""
    return [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]


def kmeans_cluster_sizes(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``(prediction, count)`` ordered by prediction."""
    return model.transform(df).groupBy("prediction").count().orderBy("prediction")
