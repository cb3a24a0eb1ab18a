"""Sums without rounding against rational arithmetic."""

import math
import random
import statistics
from fractions import Fraction

import pytest

from conftest import rows
from lodestar.functions.exact import exact_sums
from lodestar.operators import features


def values(kind, n=400):
    rng = random.Random(kind)
    make = {"mixed": lambda: rng.choice([1, -1]) * rng.random() * 2.0 ** rng.randint(-40, 60), "wide": lambda: rng.choice([1e300, -1e300, 1e-300, 5e-324, 0.1, -0.0, 1e16]),
            "cents": lambda: rng.randrange(100_000) / 100, "near": lambda: 1e15 + rng.random(), "powers": lambda: 2.0 ** rng.randint(-1074, 1000)}[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["mixed", "wide", "cents", "near", "powers"])
def test_sums_are_exact_in_any_order(spark, kind):
    xs = values(kind)
    data = [(x, None if i % 3 else x) for i, x in enumerate(xs)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE")
    got = [exact_sums(d, ["a", "b"]) for d in (df.repartition(1), df.repartition(6), df.orderBy("a"))]
    assert got[0] == got[1] == got[2]
    a, b = got[0]["a"], got[0]["b"]
    assert a.n == len(xs) and a.total == sum(map(Fraction, xs)) and a.squares == sum(Fraction(x) ** 2 for x in xs)
    assert b.n == len(xs[::3]) and b.total == sum(map(Fraction, xs[::3]))


@pytest.mark.parametrize("kind", ["mixed", "cents", "near"])
def test_statistics_are_rounded_once(spark, kind):
    xs = values(kind)
    s = exact_sums(spark.createDataFrame([(x,) for x in xs], "a DOUBLE").repartition(5), ["a"])["a"]
    exact = list(map(Fraction, xs))
    assert s.mean == float(sum(exact) / len(exact))
    assert s.std(1) == pytest.approx(statistics.stdev(xs), rel=1e-15) and s.std(0) == pytest.approx(statistics.pstdev(xs), rel=1e-15)


def test_empty_null_constant_and_unbounded_columns(spark):
    df = spark.createDataFrame([(None, 2.5, math.inf, 1), (None, 2.5, math.nan, 2)], "n DOUBLE, c DOUBLE, i DOUBLE, k INT")
    out = rows(features.exact_column_stats(df, ["n", "c", "k"]))
    assert out == [("c", 2, 2.5, 0.0, 0.0), ("k", 2, 1.5, math.sqrt(0.5), 0.5), ("n", 0, None, None, None)]
    s = exact_sums(df, ["i"])["i"]
    assert s.n == s.others == 2 and math.isnan(s.mean) and math.isnan(s.std(0))
    assert exact_sums(df.where("false"), ["c"])["c"].mean is None and exact_sums(df.limit(1), ["c"])["c"].std(1) is None


def test_standardizer_is_bit_equal_under_partitionings(spark):
    df = spark.createDataFrame([(x,) for x in values("mixed", 2000)], "a DOUBLE")
    stats = {tuple(features.fit_standardizer(df.repartition(n), ["a"], 0, exact=True)) for n in (1, 3, 8)}
    assert len(stats) == 1
