import math

from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import features as FT

POINTS = "num_feature_1 DOUBLE, num_feature_2 DOUBLE, num_feature_3 DOUBLE, category_1 STRING, label INT"


def test_derive_and_filter_nulls_nan_empty(spark):
    df = spark.createDataFrame([
        (10.0, 0.0, 0.0, "Red", 1),        # 13 > 11 kept
        (10.0, 0.0, 0.0, None, 1),         # null category: dropped
        (12.0, 0.0, 0.0, "", 1),           # empty string: 12 > 11 kept
        (float("nan"), 0.0, 0.0, "Red", 1),  # NaN: dropped
        (10.0, 0.1, 0.15, "Red", 0),       # 0.25 >= 0.2: dropped
        (None, 0.0, 0.0, "Red", 0),        # null feature: dropped
    ], POINTS)
    out = FT.derive_and_filter(df, 11.0, 0.2)
    assert rows(out, "num_feature_1", "new_feature") == [(10.0, 13.0), (12.0, 12.0)]


def test_standardize_invariants_and_zero_variance(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(1, 11)], "x DOUBLE, c DOUBLE")
    for ddof, digits in [(0, None), (1, None), (0, 12), (1, 12)]:
        out = FT.standardize(df, ["x", "c"], ddof=ddof, digits=digits)
        r = out.agg(F.avg("x"), F.stddev_samp("x") if ddof else F.stddev_pop("x"),
                    F.min("c"), F.max("c")).first()
        assert abs(r[0]) < 1e-11 and abs(r[1] - 1.0) < 1e-11
        assert r[2] == 0.0 and r[3] == 0.0


def test_statistics_at_significant_digits(spark):
    df = spark.createDataFrame([(i * 0.37 % 5,) for i in range(1000)], "x DOUBLE")
    a = FT.fit_standardizer(df, ["x"], 0)[0]
    b = FT.fit_standardizer(df, ["x"], 0, digits=12)[0]
    assert math.isclose(a[0], b[0], rel_tol=1e-11) and math.isclose(a[1], b[1], rel_tol=1e-11)
    assert b == FT.fit_standardizer(df.repartition(7), ["x"], 0, digits=12)[0]


def test_statistics_of_tiny_and_shifted_values(spark):
    df = spark.range(1000).select(((F.col("id") % 10) * 1e-6).alias("tiny"), ((F.col("id") % 8) + 1e9).alias("shifted"))
    (m1, s1), (m2, s2) = FT.fit_standardizer(df, ["tiny", "shifted"], 0, digits=12)
    assert math.isclose(m1, 4.5e-6, rel_tol=1e-9) and math.isclose(s1, 2.8722813232690143e-6, rel_tol=1e-9)
    assert math.isclose(m2, 1e9 + 3.5, rel_tol=1e-11) and math.isclose(s2, 2.29128784747792, rel_tol=1e-6)


def test_mllib_standardize_matches_expressions(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(20)], "a DOUBLE, b DOUBLE")
    m = FT.mllib_standardize(df, ["a", "b"]).collect()
    e = FT.standardize(df, ["a", "b"], ddof=1).collect()
    for x, y in zip(sorted(map(tuple, m)), sorted(map(tuple, e))):
        assert all(math.isclose(p, q, abs_tol=1e-9) for p, q in zip(x, y))


def test_column_stats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x DOUBLE")
    r = FT.column_stats(df, ["x"]).first()
    assert r["column"] == "x" and r["n"] == 3 and r["mean"] == 2.0
    assert math.isclose(r["std_samp"], 1.0) and math.isclose(r["std_pop"], math.sqrt(2 / 3))
