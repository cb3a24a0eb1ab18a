import os

from pyspark.sql import functions as F

from conftest import rows
from lodestar.session import shared_dir
from lodestar.sources import edges as E
from lodestar.sources import points as P
from lodestar.sources.synth import generate_points


def write_text(path, text):
    path = path.removeprefix("file://")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_points_fixed_and_bad_values(spark):
    d = shared_dir(spark, "pts")
    write_text(f"{d}/a.csv", "num_feature_1,num_feature_2,num_feature_3,category_1,category_2,label\n"
                             "1.0,2.0,3.0,Red,A,1\n"
                             "1.0,,3.0,,B,0\n"
                             "abc,2.0,NaN,Blue,C,1\n")
    df = P.read_points(spark, d)
    r = df.orderBy("label", "category_2").collect()
    assert len(r) == 3
    assert r[0]["num_feature_2"] is None and r[0]["category_1"] is None
    bad = [x for x in r if x["category_1"] == "Blue"][0]
    assert bad["num_feature_1"] is None and bad["num_feature_3"] != bad["num_feature_3"]  # NaN
    inferred = P.read_points(spark, d, schema=None)
    assert dict(inferred.dtypes)["label"] == "int"


def test_read_edges_tab_and_space(spark):
    d = shared_dir(spark, "edges")
    write_text(f"{d}/g.txt", "u\tv\n1\t2\n2\t3\n")
    assert rows(E.read_edges(spark, d, sep="\t")) == [(1, 2), (2, 3)]
    d2 = shared_dir(spark, "edges2")
    write_text(f"{d2}/g.txt", "u v\n1 2\n4 4\n")
    assert rows(E.read_edges(spark, d2, sep=" ")) == [(1, 2), (4, 4)]


def test_read_edge_list_whitespace_comments_bad(spark):
    d = shared_dir(spark, "el")
    write_text(f"{d}/g.txt", "FromNodeId ToNodeId\n# comment\n1   2\n2\t3\n\nx 7\n3000000000 1\n")
    assert rows(E.read_edge_list(spark, d, on_bad="drop")) == [(1, 2), (2, 3), (3000000000, 1)]


def test_edge_list_roundtrip(spark):
    e = spark.createDataFrame([(1, 2), (5, 9)], "src BIGINT, dst BIGINT")
    d = shared_dir(spark, "rt")
    E.write_edge_list(e.repartition(2), d)
    assert rows(E.read_edge_list(spark, d)) == [(1, 2), (5, 9)]
    assert rows(E.read_edges(spark, d, sep=" ")) == [(1, 2), (5, 9)]


def test_generate_points_exact_and_partition_independent(spark):
    a = generate_points(spark, 5000, seed=42, num_partitions=1)
    b = generate_points(spark, 5000, seed=42, num_partitions=7)
    assert a.count() == 5000
    h = lambda df: df.select(F.bit_xor(F.xxhash64(*df.columns))).first()[0]
    assert h(a) == h(b)
    r = a.agg(F.avg("label"), F.countDistinct("category_2"), F.countDistinct("num_feature_1")).first()
    assert 0.4 < r[0] < 0.6 and r[1] == 4 and r[2] == 5000
    assert generate_points(spark, 10, seed=1).collect() != generate_points(spark, 10, seed=2).collect()


def test_edge_list_with_short_and_long_lines(spark):
    d = shared_dir(spark, "short")
    spark.createDataFrame([("1 2",), ("3",), ("4 5 6",), ("",), ("x 7",)], "value STRING").coalesce(1).write.text(d)
    assert rows(E.read_edge_list(spark, d, header=False, on_bad="drop")) == [(1, 2), (4, 5)]
    kept = E.read_edge_list(spark, d, header=False, on_bad="null").collect()
    assert sorted((r["src"] or 0, r["dst"] or 0) for r in kept) == [(0, 7), (1, 2), (3, 0), (4, 5)]


def test_part_graph_tasks_follow_the_rows(spark, tmp_path, monkeypatch):
    """Lines are shuffled once by order, and neither they nor the pairs make a task larger than set."""
    import itertools
    from lodestar.sources import tables
    lines = [(o, (o * 7 + i * i) % 50) for o in range(200) for i in range(6)] + [(None, 1), (3, None), (3, 4), (3, 4)]
    spark.createDataFrame(lines, "l_orderkey BIGINT, l_partkey BIGINT").write.parquet(str(tmp_path / "lineitem.parquet"))
    by_order = {}
    for o, p in lines:
        if o is not None and p is not None:
            by_order.setdefault(o, set()).add(p)
    expect = {(a, b) for s in by_order.values() for a, b in itertools.combinations(sorted(s), 2)}
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    for hot in (5000, 4):
        e = tables.part_graph(spark, str(tmp_path), hot_parts=hot)
        assert sorted(map(tuple, e.collect())) == sorted(expect)
        pairs = sum(n * (n - 1) // 2 for n in (len([1 for o, _ in lines if o == k]) for k in by_order))
        assert e.rdd.getNumPartitions() == -(-pairs // 100)
    plan = tables.part_graph(spark, str(tmp_path))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning(l_orderkey") <= 2 and "REPARTITION_BY_NUM" in physical
