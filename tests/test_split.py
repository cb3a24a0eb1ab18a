import pytest

from conftest import SF_SMALL, rows
from lodestar.operators import split as S
from lodestar.sources.tables import POINT_KEY, points_view


def test_tail_split_exact(spark):
    import random
    keys = list(range(1000))
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k BIGINT, g INT").repartition(5)
    for frac in (0.3, 0.5, 0.01):
        out = S.with_tail_side(df, ["k"], frac, look=20)
        train = sorted(r["k"] for r in out.filter("is_train").collect())
        n_train = int(1000 * (1 - frac))
        assert train == list(range(n_train))
        assert out.count() == 1000


def test_tail_split_composite_key_with_hot_leading_value(spark):
    data = [(0, i) for i in range(500)] + [(i, 0) for i in range(1, 300)]
    df = spark.createDataFrame(data, "a BIGINT, b BIGINT")
    train, valid = S.tail_split(df, ["a", "b"], 0.3)
    n_train = int(799 * 0.7)
    expect = sorted(data)[:n_train]
    assert rows(train) == expect and valid.count() == 799 - n_train


def test_hash_split_disjoint_cover_and_stable(spark):
    p = points_view(spark, SF_SMALL)
    train, valid = S.hash_split(p, POINT_KEY, 0.7)
    nt, nv = train.count(), valid.count()
    assert nt + nv == 6000 and 0.6 < nt / 6000 < 0.8
    a = rows(S.with_hash_side(p, POINT_KEY).select(*POINT_KEY, "bucket"))
    b = rows(S.with_hash_side(p.repartition(7), POINT_KEY).select(*POINT_KEY, "bucket"))
    assert a == b


def test_random_split_covers(spark):
    df = spark.range(1000)
    t, v = S.random_split(df, 0.7, 42)
    assert t.count() + v.count() == 1000
    assert t.join(v, "id").count() == 0


@pytest.mark.parametrize("look", [1, 30, 500])
def test_tail_split_iterative_narrowing(spark, look):
    import random
    keys = [(a, b) for a in range(40) for b in range(30)]
    random.Random(9).shuffle(keys)
    df = spark.createDataFrame(keys, "a BIGINT, b BIGINT").repartition(6)
    out = S.with_tail_side(df, ["a", "b"], 0.3, look=look)
    n_train = int(1200 * 0.7)
    assert sorted(tuple(r[:2]) for r in out.filter("is_train").collect()) == sorted(keys)[:n_train]
    assert out.count() == 1200


def test_tail_split_repeated_key_at_cut(spark):
    data = [(1, i) for i in range(10)] + [(2, 0)] * 50 + [(3, i) for i in range(40)]
    df = spark.createDataFrame(data, "a BIGINT, b BIGINT")
    out = S.with_tail_side(df, ["a", "b"], 0.3, look=4)
    assert out.filter("is_train").count() == 70
    # sorted: 10 rows a=1, 50 copies of (2, 0), then a=3 with b = 0..39 -> the first 70 are train
    assert sorted(r["b"] for r in out.filter("is_train AND a = 3").collect()) == list(range(10))
    assert out.filter("NOT is_train AND a <= 2").count() == 0


def test_tail_split_cut_inside_repeated_key(spark):
    data = [(1, i) for i in range(10)] + [(2, 0)] * 80 + [(3, i) for i in range(10)]
    df = spark.createDataFrame(data, "a BIGINT, b BIGINT").repartition(4)
    out = S.with_tail_side(df, ["a", "b"], 0.3, look=4)
    assert out.count() == 100 and out.filter("is_train").count() == 70
    assert out.filter("is_train AND a = 2").count() == 60
    assert out.filter("NOT is_train AND a = 1").count() == 0 and out.filter("is_train AND a = 3").count() == 0


@pytest.mark.parametrize("persist", [True, False])
def test_tail_split_counts_hold_after_a_shuffle_of_wide_rows(spark, persist):
    """All rows have one key: exactly the asked number is train, whatever is read with it."""
    from pyspark.sql import functions as F
    df = spark.range(30_000).select(F.lit(1).alias("k"), "id", F.repeat(F.lit("x"), 200).alias("wide")).repartition("id")
    out = S.with_tail_side(df, ["k"], 0.3, persist=persist)
    assert out.filter("is_train").select(F.max("wide"), F.count("*")).first()[1] == 21_000
    assert out.count() == 30_000 and out.select("id").distinct().count() == 30_000


def test_tail_split_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 40 + [(0, "b")] * 5, "k INT, v STRING")
    out = S.with_tail_side(df, ["k"], 0.4, look=2)
    assert out.count() == 45 and out.filter("is_train").count() == 27
    assert out.filter("is_train and k = 0").count() == 5


def test_tail_split_puts_nulls_first_and_loses_none(spark):
    keys = [None] * 100 + list(range(900))
    df = spark.createDataFrame([(k,) for k in keys], "k INT").repartition(5)
    for look in (2, 64):
        out = S.with_tail_side(df, ["k"], 0.3, look=look)
        assert out.count() == 1000 and out.filter("is_train").count() == 700
        assert out.filter("is_train and k is null").count() == 100
        assert out.filter("is_train").agg({"k": "max"}).first()[0] == 599


def test_tail_split_leaves_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    S.with_tail_side(spark.range(100), ["id"], 0.3).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def _order(v):
    return (v is not None, v is not None and v != v, v if v is not None and v == v else 0)


@pytest.mark.parametrize("kind", ["DOUBLE", "FLOAT", "STRING", "DATE", "TIMESTAMP", "DECIMAL(9,2)", "INT", "BOOLEAN"])
@pytest.mark.parametrize("rank", [1, 333, 640])
def test_cut_of_any_type_of_key(spark, kind, rank):
    """The row at a rank, what lies before it and its copies, with nulls, NaN and repeated values."""
    import datetime
    import decimal
    import random
    rng = random.Random(rank)
    make = {"DOUBLE": lambda: rng.choice([float("nan"), rng.gauss(0, 1), 0.5, -1e300]), "FLOAT": lambda: rng.choice([float("nan"), float(rng.randrange(9)), 1.5]),
            "STRING": lambda: "".join(rng.choices("ab", k=rng.randrange(6))), "DATE": lambda: datetime.date(2020, 1, 1) + datetime.timedelta(rng.randrange(-50, 50)),
            "TIMESTAMP": lambda: datetime.datetime(2020, 1, 1) + datetime.timedelta(microseconds=rng.randrange(200)),
            "DECIMAL(9,2)": lambda: decimal.Decimal(rng.randrange(-300, 300)) / 100, "INT": lambda: rng.randrange(-20, 20), "BOOLEAN": lambda: rng.random() < 0.3}[kind]
    data = [(make() if rng.random() > 0.1 else None, rng.choice([None, *range(5)])) for _ in range(700)]
    df = spark.createDataFrame(data, f"a {kind}, b INT").repartition(3)
    plain = sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(_order, r)))
    same = lambda r: tuple(map(_order, r))
    want = same(plain[rank - 1])
    at, before, copies = S.find_cut(df, ["a", "b"], rank, 700, look=5)
    assert same(at) == want and before == [same(r) for r in plain].index(want) and copies == sum(same(r) == want for r in plain)


def test_a_few_rounds_find_a_cut_in_many_rows(spark):
    df = spark.range(300_000).selectExpr("id * 7919 % 300007 as a", "id")
    seen = []
    real = S._Column
    try:
        S._Column = lambda *args: seen.append(1) or real(*args)
        at, before, copies = S.find_cut(df, ["a", "id"], 210_000, 300_000)
    finally:
        S._Column = real
    assert (before, copies) == (209_999, 1) and len(seen) == 1


def test_random_split_sorts_bounded_tasks(spark, monkeypatch):
    """Both sides read the rows from one stored table, in tasks of a bounded number of rows, and lose none."""
    monkeypatch.setattr(S, "SORTED", 100)
    df = spark.range(0, 1000, 1, 2).selectExpr("id", "if(id % 3 = 0, null, id % 7) AS k", "map('a', id) AS m")
    train, valid = S.random_split(df, 0.7, seed=5)
    assert train.rdd.getNumPartitions() == valid.rdd.getNumPartitions() == 10
    assert "Range" not in train._jdf.queryExecution().toString()
    ids = [[r["id"] for r in side.collect()] for side in (train, valid)]
    assert sorted(ids[0] + ids[1]) == list(range(1000)) and 600 < len(ids[0]) < 800
    assert ids[0] == [r["id"] for r in train.collect()]
