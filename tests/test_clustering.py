from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from lodestar.functions.distance import allclose, array_squared_distance, nearest_center
from lodestar.operators import clustering as CL
from lodestar.sources.tables import FEATURES, POINT_KEY, points_view


def test_tie_goes_to_lowest_index(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0)], "x DOUBLE, y DOUBLE")
    out = df.withColumn("c", nearest_center(["x", "y"], [(1.0, 0.0), (-1.0, 0.0), (0.0, 5.0)]))
    assert rows(out, "x", "c") == [(-1.0, 1), (0.0, 0), (1.0, 0)]


def test_array_distance(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v ARRAY<DOUBLE>")
    assert df.select(array_squared_distance("v", [1.0, 0.0, 0.0])).first()[0] == 13.0


def test_empty_cluster_gets_zero_vector(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (9.0, 9.0)], "x DOUBLE, y DOUBLE")
    a = CL.assign_nearest(df, ["x", "y"], [(0.0, 0.0), (10.0, 10.0), (100.0, 100.0)])
    assert CL.update_centers(a, ["x", "y"], 3) == [[1.5, 1.5], [9.0, 9.0], [0.0, 0.0]]
    frame = rows(CL.update_centers_frame(a, ["x", "y"], 3))
    assert frame == [(0, 1.5, 1.5, 2), (1, 9.0, 9.0, 1), (2, 0.0, 0.0, 0)]


def test_convergence_returns_current_centers(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 2), (10.0, 3), (11.0, 4)], "x DOUBLE, k INT")
    res = CL.lloyd_kmeans(df, ["x"], k=2, max_iters=10, init=[[0.5], [10.5]])
    assert res.converged and res.iterations == 1 and res.centers == [[0.5], [10.5]]
    res = CL.lloyd_kmeans(df, ["x"], k=2, max_iters=10, key=["k"])
    assert res.converged and res.centers == [[0.5], [10.5]]
    assert allclose([[1.0]], [[1.0 + 1e-9]])


def test_lloyd_golden_sf0001_and_partition_independent(spark):
    p = points_view(spark, SF_SMALL)
    res, sizes, _ = CL.lloyd_standardized(p, FEATURES, POINT_KEY, k=2, max_iters=3)
    assert sizes == [(0, 3107), (1, 2893)]
    assert [round(x, 6) for x in res.centers[0]] == [0.800071, -0.057471, 0.026096]
    assert [round(x, 6) for x in res.centers[1]] == [-0.925459, 0.066478, -0.030186]
    res2, sizes2, _ = CL.lloyd_standardized(p.repartition(7), FEATURES, POINT_KEY, k=2, max_iters=3)
    assert sizes2 == sizes and all(abs(a - b) < 1e-12 for c1, c2 in zip(res.centers, res2.centers)
                                   for a, b in zip(c1, c2))


def test_mllib_kmeans_sizes_sum(spark):
    p = points_view(spark, SF_SMALL).select(*FEATURES)
    model = CL.fit_kmeans(p, FEATURES, k=2, max_iter=3, seed=42)
    sizes = CL.kmeans_cluster_sizes(model, p).collect()
    assert sum(r["count"] for r in sizes) == 6000 and len(sizes) == 2
    assert len(CL.kmeans_centers(model, FEATURES)) == 2


def test_lloyd_with_invalid_points(spark):
    import pytest
    data = [(i, float(i % 2) * 10 + i * 0.01, 1.0) for i in range(20)] + [(90, None, 1.0), (91, float("nan"), 1.0)]
    df = spark.createDataFrame(data, "id INT, x DOUBLE, y DOUBLE")
    with pytest.raises(ValueError, match="2 points"):
        CL.lloyd_kmeans(df, ["x", "y"], key=["id"])
    with pytest.raises(ValueError, match="2 points"):
        CL.lloyd_standardized(df, ["x", "y"], ["id"])
    res, sizes, _ = CL.lloyd_standardized(df, ["x", "y"], ["id"], handle_invalid="skip")
    assert sorted(n for _, n in sizes) == [10, 10] and all(c == c for r in res.centers for c in r)


def test_lloyd_of_tiny_values_is_not_flattened(spark):
    df = spark.range(100).select("id", ((F.col("id") % 10) * 1e-6).alias("x"))
    _, sizes, stats = CL.lloyd_standardized(df, ["x"], ["id"], max_iters=20)
    assert stats[0][1] > 2e-6 and [n for _, n in sizes] == [50, 50]


def test_seeded_points_are_joined_once(spark):
    """The passes of the seeded k-means read stored points instead of joining lines and orders again."""
    from lodestar.plans import catalog
    pts, _ = catalog._seeded(spark, SF_SMALL)
    assert "Join" not in pts._jdf.queryExecution().toString()
