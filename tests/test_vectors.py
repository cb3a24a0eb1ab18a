"""Array columns: assignment, sums, Lloyd's iteration and k-means|| against plain numpy, and under partitionings."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import clustering, seeding, vectors as V


def plain(x, centers):
    """Sums of squared differences in order of the dimensions; the first of equal ones."""
    out = []
    for p in x:
        d = []
        for c in centers:
            total = 0.0
            for a, b in zip(p, c):
                total += (a - b) * (a - b)
            d.append(total)
        out.append(int(np.argmin(d)))
    return out


@pytest.mark.parametrize("k,d", [(1, 1), (3, 2), (40, 5), (300, 16)])
def test_nearest_with_ties_and_copies(k, d):
    rng = np.random.default_rng(k)
    centers = np.round(rng.standard_normal((k, d)), 1)
    centers[k // 2] = centers[0]
    x = np.concatenate([np.round(rng.standard_normal((200, d)), 1), centers, (centers[:1] + centers[-1:]) / 2, 1e8 + centers])
    assert V.nearest(x, centers).tolist() == plain(x, centers)
    apart = V.squared_distances(centers, centers)
    last = np.array(plain(x, centers + 0.01))
    assert V.nearest_from(x, last, centers, apart).tolist() == plain(x, centers)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.standard_normal((150, 6)) + 4 * c for c in range(4)])
    data = [(i, p.tolist()) for i, p in enumerate(x)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [math.nan] * 6)]
    return spark.createDataFrame(data, "id LONG, v ARRAY<DOUBLE>"), x


def test_assignment_leaves_invalid_vectors_without_cluster(points):
    df, x = points
    centers = x[::100]
    for last in (None, "before"):
        some = df.withColumn("before", F.when(F.col("id") % 3 > 0, F.lit(2))).repartition(4)
        got = dict(rows(V.assigned(some, "v", centers, last=last).select("id", "cluster").fillna(-1)))
        assert [got[i] for i in range(len(x))] == plain(x, centers) and {got[i] for i in (900, 901, 902)} == {-1}
    assert V.assigned(df.where("false"), "v", centers).count() == 0


def test_vector_sums(points):
    df, x = points
    valid = df.where("id < 900")
    mean, std = V.vector_statistics(valid, "v", 0)
    assert np.allclose(mean, x.mean(0)) and np.allclose(std, x.std(0)) and np.allclose(V.vector_statistics(valid, "v", 1)[1], x.std(0, ddof=1))
    z = np.array([r["v"] for r in V.standardized(valid, "v", mean, [*std[:-1], 0.0]).orderBy("id").collect()])
    assert np.allclose(z[:, :-1], ((x - x.mean(0)) / x.std(0))[:, :-1]) and (z[:, -1] == 0).all()


@pytest.mark.parametrize("prune", [False, True])
def test_lloyd_is_that_of_named_columns(spark, points, prune):
    df, x = points
    named = spark.createDataFrame([(i, *p) for i, p in enumerate(x.tolist())], "id LONG, " + ", ".join(f"c{j} DOUBLE" for j in range(6)))
    cols = [f"c{j}" for j in range(6)]
    a = V.lloyd(df.where("id < 900"), "v", k=4, max_iters=8, key=["id"], prune=prune)
    b = clustering.lloyd_kmeans(named, cols, k=4, max_iters=8, key=["id"])
    assert np.allclose(a.centers, b.centers) and (a.iterations, a.converged) == (b.iterations, b.converged)
    far = V.lloyd(df.where("id < 900"), "v", max_iters=1, init=[[0.0] * 6, [1e6] * 6], prune=prune)
    assert far.centers[1] == [0.0] * 6 and np.allclose(far.centers[0], x.mean(0))


def test_parallel_centers_do_not_move_with_partitions(points):
    df, x = points
    found = [seeding.parallel_centers(df.repartition(n), "v", ["id"], k=4, seed=s) for s in (1, 2) for n in (1, 6)]
    assert found[0] == found[1] and found[2] == found[3] and found[0] != found[2]
    for centers in found:
        assert len(centers) == 4 and all(c in x.tolist() for c in centers)
    cost = lambda c: V.squared_distances(x, np.array(c)).min(1).sum()
    plain_choice = np.mean([cost(x[np.random.default_rng(s).choice(len(x), 4, replace=False)]) for s in range(20)])
    assert np.mean([cost(c) for c in found]) < plain_choice


def test_parallel_centers_of_few_points(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(20)], "id LONG, v ARRAY<DOUBLE>")
    assert seeding.parallel_centers(same, "v", ["id"], k=3) == [[1.0, 2.0]]
    assert seeding.parallel_centers(same.where("false"), "v", ["id"], k=3) == []
    two = spark.createDataFrame([(i, [float(i % 2)]) for i in range(20)], "id LONG, v ARRAY<DOUBLE>")
    assert Counter(map(tuple, seeding.parallel_centers(two, "v", ["id"], k=5, oversampling=50))) == {(0.0,): 1, (1.0,): 1}


def test_reduction_draws_by_weight():
    candidates = [[0.0], [0.1], [10.0], [20.0]]
    picks = [tuple(sorted(seeding.reduced(candidates, [100, 100, 50, 0], 2, s))) for s in range(40)]
    assert all(3 not in p for p in picks) and sum(2 in p for p in picks) > 30
    assert seeding.reduced([[1.0], [1.0]], [1, 1], 2, 0) in ([0], [1])
