"""Hash-bagged forests: draws, bins and scores that do not move with partitions."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import bagging as B

KEY = ["id"]


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(3000).select("id", (F.col("id") * 7919 % 1009 / 10.0).alias("x"), (F.col("id") * 104729 % 97).cast("double").alias("y"))
    return df.withColumn("label", ((F.col("x") + F.col("y") > 90) != (F.col("id") % 13 == 0)).cast("int"))


def test_draws_have_their_distribution(points):
    w = B.bag_weights(points.select("id"), KEY, 2, 1.0, True).toPandas()
    for c in ("w0", "w1"):
        counts = Counter(w[c].tolist())
        for k in range(4):
            assert abs(counts[k] / 3000 - math.exp(-1) / math.factorial(k)) < 0.03
    assert abs(np.corrcoef(w["w0"], w["w1"])[0, 1]) < 0.06
    kept = B.bag_weights(points.select("id"), KEY, 1, 0.8, False).agg(F.avg("w0")).first()[0]
    assert abs(kept - 0.8) < 0.03
    assert B.bag_weights(points.select("id"), KEY, 1, 1.0, False).agg(F.min("w0")).first()[0] == 1


@pytest.mark.parametrize("replacement", [True, False])
def test_scores_do_not_move_with_partitions(points, replacement):
    args = dict(num_trees=3, max_depth=3, rate=0.8, replacement=replacement, feature_fraction=0.5)
    got = []
    for n in (1, 7):
        df = points.repartition(n)
        model = B.fit_bagged_forest(df, ["x", "y"], KEY, **args)
        got.append((model.cuts, rows(B.staged_scores(model, df, ["id"]).select("id", F.concat_ws(",", F.col("stages").cast("array<string>"))))))
    assert got[0] == got[1]


def test_stages_and_metrics(points):
    model = B.fit_bagged_forest(points, ["x", "y"], KEY, num_trees=3, max_depth=4)
    staged = B.staged_scores(model, points, ["id", "label"])
    table = staged.toPandas()
    p = np.array(table["stages"].tolist())
    alone = [t.transform for t in model.trees]
    assert len(alone) == p.shape[1] == 3 and (np.diff(p, axis=1) != 0).any()
    got = {r["trees"]: r for r in B.staged_metrics(staged).collect()}
    y = table["label"].to_numpy()
    for t in (1, 2, 3):
        q = np.clip(p[:, t - 1], 1e-15, 1 - 1e-15)
        assert got[t]["n"] == 3000 and got[t]["accuracy"] == pytest.approx(((p[:, t - 1] > 0.5) == y).mean())
        assert got[t]["log_loss"] == pytest.approx(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    scored = B.bagged_scores(model, points, ["id", "label"])
    assert scored.where("prediction = label").count() / 3000 == pytest.approx(got[3]["accuracy"]) and got[3]["accuracy"] > 0.8


def test_bins_of_constant_null_and_few_values(spark):
    df = spark.createDataFrame([(i, 1.0, float(i % 3), None if i % 2 else float(i)) for i in range(50)], "id LONG, a DOUBLE, b DOUBLE, c DOUBLE")
    cuts = B.fit_bins(df, ["a", "b", "c"], KEY, max_bins=8)
    assert cuts["a"] == [1.0] and cuts["b"] == [0.0, 1.0, 2.0] and len(cuts["c"]) == 7
    out = B.bin_columns(df.where("c is not null"), cuts).select("b", "b__bin").distinct()
    assert rows(out) == [(0.0, 1.0), (1.0, 2.0), (2.0, 3.0)]
    with pytest.raises(Exception):
        B.fit_bagged_forest(df.withColumn("label", (F.col("id") % 4 > 1).cast("int")), ["b", "c"], KEY, num_trees=1)
    assert B.bin_columns(df, cuts, handle_invalid="skip").count() == 25
    none = df.where("false")
    assert B.fit_bins(none, ["a"], KEY) == {"a": []} and B.bin_columns(none, {"a": []}).count() == 0


def test_columns_of_each_tree():
    cols = [f"c{i}" for i in range(10)]
    some = B.tree_features(cols, 5, 0.3, seed=1)
    assert all(len(s) == 3 and s == [c for c in cols if c in s] for s in some) and len({tuple(s) for s in some}) > 1
    assert B.tree_features(cols, 2) == [cols, cols]
