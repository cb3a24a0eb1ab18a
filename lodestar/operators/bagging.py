"""A forest whose draws are hashes of the rows' keys.

MLlib's forest draws rows per partition, so its trees move with the partitioning.  Here
every (row, tree) pair gets a weight from a hash of the row's key (:func:`bag_weights`), and each tree is an
MLlib decision tree with that weight column; features are cut into bins at quantiles of
the rows of least hash (:func:`fit_bins`).  So a forest depends on the rows, their
keys and the seed, and on nothing else.  (MLlib merges neighbouring leaves of one class.)

The score of a row after ``t`` trees is the mean of their probabilities (:func:`staged_scores`), so one
pass over the scored rows gives the metrics of every number of trees (:func:`staged_metrics`).

Rows with a null key column hash as if that column were not there; null features raise an error unless ``handle_invalid="skip"``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.hashing import key_string, uniform
from lodestar.session import persisted

MAX_POISSON = 12      # a larger count has a probability below 2^-32 at rate 1
BIN_SAMPLE = 10_000   # rows whose features come to the driver for the bins


def bag_weight(key: Sequence[str], tree: int, rate: float = 1.0, replacement: bool = True, seed: int = 42) -> Column:
    """How often a row is drawn for a tree: with replacement a Poisson count with mean ``rate``, else 1 with probability ``rate``."""
    u = uniform(key, seed, f"tree{tree}")
    if not replacement:
        return (u < F.lit(float(rate))).cast("int")
    return sum(((u >= F.lit(p)).cast("int") for p in poisson_steps(rate)), F.lit(0))


def poisson_steps(rate: float) -> list[float]:
    """Probabilities of at most 0, 1, ... draws."""
    return [math.exp(-rate) * sum(rate ** i / math.factorial(i) for i in range(k + 1)) for k in range(MAX_POISSON)]


def bag_weights(df: DataFrame, key: Sequence[str], num_trees: int, rate: float = 1.0, replacement: bool = True, seed: int = 42,
                prefix: str = "w") -> DataFrame:
    """``df`` with a weight column ``w0, w1, ...`` for each tree."""
    return df.withColumns({f"{prefix}{t}": bag_weight(key, t, rate, replacement, seed) for t in range(num_trees)})


def fit_bins(df: DataFrame, cols: Sequence[str], key: Sequence[str], max_bins: int = 32, sample: int = BIN_SAMPLE) -> dict[str, list[float]]:
    """Ascending cuts of each column: the values at ``i / max_bins`` of the sorted sample, of the ``sample`` rows whose keys have the least md5."""
    rows = df.select(*cols, F.md5(key_string(key)).alias("_h"), key_string(key).alias("_k")).orderBy("_h", "_k", *cols).limit(sample).drop("_h", "_k").collect()
    cuts = {}
    for c in cols:
        values = sorted(float(r[c]) for r in rows if r[c] is not None and not math.isnan(r[c]))
        cuts[c] = sorted({values[i * len(values) // max_bins] for i in range(1, max_bins)}) if values else []
    return cuts


def bin_columns(df: DataFrame, cuts: dict[str, list[float]], suffix: str = "__bin", handle_invalid: str = "error") -> DataFrame:
    """For each column the number of its cuts that are not above the value, as ``column + suffix``."""
    some = [c for c in cuts if cuts[c]]
    if some:
        df = Bucketizer(splitsArray=[[-math.inf, *cuts[c], math.inf] for c in some], inputCols=some, outputCols=[c + suffix for c in some],
                        handleInvalid=handle_invalid).transform(df)
        df = df.withColumns({c + suffix: F.col(c + suffix) + 0.0 for c in some})  # ordered numbers: without the mark of categories
    return df.withColumns({c + suffix: F.lit(0.0) for c in cuts if not cuts[c]})


def tree_features(cols: Sequence[str], num_trees: int, fraction: float = 1.0, seed: int = 42) -> list[list[str]]:
    """The columns that each tree may use: those with the least hash of (seed, tree, column), in their own order."""
    import hashlib
    n = max(1, math.ceil(len(cols) * fraction))
    out = []
    for t in range(num_trees):
        least = sorted(cols, key=lambda c: hashlib.md5(f"{seed}:tree{t}:{c}".encode()).hexdigest())[:n]
        out.append([c for c in cols if c in least])
    return out


@dataclass
class BaggedForest:
    cuts: dict[str, list[float]]
    features: list[list[str]]                         # of each tree
    trees: list[DecisionTreeClassificationModel]


def fit_bagged_forest(train: DataFrame, cols: Sequence[str], key: Sequence[str], label: str = "label", num_trees: int = 4, max_depth: int = 3,
                      rate: float = 1.0, replacement: bool = True, feature_fraction: float = 1.0, max_bins: int = 32, seed: int = 42,
                      handle_invalid: str = "error") -> BaggedForest:
    """``num_trees`` gini trees, each on its own weighted draw of the rows and its own columns.

    The key must tell rows apart for independent draws; rows of one key are drawn together.
    ``replacement=False`` with ``rate=1`` gives every tree all rows.
    """
    cuts = fit_bins(train, cols, key, max_bins)
    binned = bin_columns(train, cuts, handle_invalid=handle_invalid)
    weighted = bag_weights(binned, key, num_trees, rate, replacement, seed)
    used = [f"{c}__bin" for c in cols] + [f"w{t}" for t in range(num_trees)]
    features = tree_features(cols, num_trees, feature_fraction, seed)
    trees = []
    with persisted(weighted.select(*used, F.col(label).cast("double").alias("_label"))) as rows:
        for t in range(num_trees):
            into = VectorAssembler(inputCols=[f"{c}__bin" for c in features[t]], outputCol=f"features_{t}")
            drawn = into.transform(rows.where(F.col(f"w{t}") > 0).select(*into.getInputCols(), "_label", F.col(f"w{t}").cast("double").alias("_weight")))
            tree = DecisionTreeClassifier(labelCol="_label", featuresCol=f"features_{t}", weightCol="_weight", maxDepth=max_depth, maxBins=max(max_bins, 2) + 1,
                                          seed=seed, predictionCol=f"prediction_{t}", probabilityCol=f"probability_{t}", rawPredictionCol=f"raw_{t}")
            trees.append(tree.fit(drawn))
    return BaggedForest(cuts, features, trees)


def staged_scores(model: BaggedForest, df: DataFrame, keep: Sequence[str] = (), handle_invalid: str = "error") -> DataFrame:
    """``keep`` and ``stages``: the probability of class 1 after 1, 2, ... trees."""
    out = bin_columns(df, model.cuts, handle_invalid=handle_invalid)
    for t, tree in enumerate(model.trees):
        into = VectorAssembler(inputCols=[f"{c}__bin" for c in model.features[t]], outputCol=f"features_{t}")
        out = tree.transform(into.transform(out)).drop(f"features_{t}", f"raw_{t}", f"prediction_{t}")
    p = [F.element_at(vector_to_array(f"probability_{t}"), 2) if tree.numClasses > 1 else F.lit(0.0) for t, tree in enumerate(model.trees)]
    total, stages = F.lit(0.0), []
    for t, x in enumerate(p):
        total = total + x
        stages.append(total / F.lit(float(t + 1)))
    return out.select(*keep, F.array(*stages).alias("stages"))


def bagged_scores(model: BaggedForest, df: DataFrame, keep: Sequence[str] = (), handle_invalid: str = "error") -> DataFrame:
    """``keep``, ``prediction`` (1 if above a half) and ``p1`` of the whole forest."""
    out = staged_scores(model, df, keep, handle_invalid)
    p1 = F.element_at("stages", -1)
    return out.select(*keep, (p1 > 0.5).cast("int").alias("prediction"), p1.alias("p1"))


def staged_metrics(staged: DataFrame, label: str = "label", eps: float = 1e-15) -> DataFrame:
    """``(trees, n, accuracy, log_loss)``: one row for each number of trees, from one aggregate over the scored rows."""
    p = F.least(F.greatest(F.col("p1"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    rows = staged.select(label, F.posexplode("stages").alias("t", "p1"))
    return rows.groupBy((F.col("t") + 1).alias("trees")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(((F.col("p1") > 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))
