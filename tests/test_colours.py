"""Triangles by colour triples and subset neighbourhoods against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import colours, graph as G


def random_graph(seed, n=60, m=420, hubs=3):
    rng = random.Random(seed)
    pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    pairs |= {(h, x) for h in range(hubs) for x in range(n) if rng.random() < 0.9}
    return sorted(pairs) + [(5, 5), (9, 2), (2, 9)]


def brute(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set())
        near.setdefault(b, set())
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return {x: sum(1 for y, z in combinations(sorted(near[x]), 2) if z in near[y]) for x in near}


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


@pytest.mark.parametrize("task_edges", [10, 60, 400, 10 ** 6])
def test_counts_and_total_for_any_size_of_task(spark, task_edges):
    pairs = random_graph(1)
    expect = brute(pairs)
    e = edges(spark, pairs)
    assert dict(rows(G.triangle_counts(e, method="colours", task_edges=task_edges))) == expect
    assert G.triangle_total(e, method="colours", task_edges=task_edges).first()["total"] == sum(expect.values()) // 3


def test_heavy_vertices_stay_out_of_the_tasks(spark):
    canon = G._stored(G.canonical_edges(edges(spark, random_graph(2))), "canon")
    deg = G.degrees(canon)
    parts = colours.Parts(canon, deg, G._stored, task_edges=40)
    limit = colours.heavy_above(parts.colours, 40)
    heavy = {r["id"] for r in deg.where(F.col("deg") > limit).collect()}
    assert heavy and parts.corners is not None
    m = canon.count()
    assert len(heavy) <= 2 * m / limit
    seen = parts.rows.select("a", "b").distinct().collect()
    assert not {x for r in seen for x in r} & heavy
    # Every edge goes to one task for each colour.
    assert parts.rows.count() == parts.colours * len(seen)


def test_empty_null_and_triangle_free(spark):
    none = edges(spark, [])
    assert G.triangle_total(none, method="colours").first()["total"] == 0
    assert rows(G.triangle_counts(none, method="colours")) == []
    star = edges(spark, [(0, i) for i in range(1, 30)] + [(None, 3), (4, None)])
    assert G.triangle_total(star, method="colours", task_edges=8).first()["total"] == 0
    assert set(rows(G.triangle_counts(star, method="colours", task_edges=8))) == {(i, 0) for i in range(30)}
    with pytest.raises(ValueError):
        G.triangle_total(star, method="wedges")


def test_colours_grow_with_the_root_of_the_edges():
    assert colours.colour_count(0) == colours.colour_count(1) == 1
    assert colours.colour_count(10 ** 11, 10 ** 6) == 775 == int(np.ceil(np.sqrt(6e5)))
    c = colours.colour_count(10 ** 11, 10 ** 6)
    assert 2 * 10 ** 11 / colours.heavy_above(c, 10 ** 6) <= 8 * c / 3 + 1
    assert colours.colour_count(400_000, 10 ** 6, cores=8) == 4 > colours.colour_count(400_000, 10 ** 6, cores=1) == 2


@pytest.mark.parametrize("method", ["adjacency", "colours"])
@pytest.mark.parametrize("max_hot", [0, 1000])
def test_subset_from_its_neighbourhood(spark, method, max_hot):
    pairs = random_graph(3, n=80, m=200, hubs=1)
    wanted = [3, 17, 40, 999, None, 3]
    nodes = spark.createDataFrame([(w,) for w in wanted], "id BIGINT")
    expect = {k: v for k, v in brute(pairs).items() if k in wanted}
    got = G.triangle_counts(edges(spark, pairs), nodes=nodes, method=method, max_hot=max(max_hot, 1))
    assert dict(rows(got)) == expect


def test_neighbourhood_keeps_what_a_subset_needs_and_no_more(spark):
    ring = [(i, i + 1) for i in range(100)]
    canon = G.canonical_edges(edges(spark, ring + [(0, 2)]))
    nodes = spark.createDataFrame([(1,)], "id BIGINT")
    assert rows(G.neighbourhood(canon, nodes)) == [(0, 1), (0, 2), (1, 2)]
    assert rows(G.neighbourhood(canon, nodes, max_hot=0)) == [(0, 1), (0, 2), (1, 2)]


@pytest.mark.parametrize("order", ["degree", "id"])
@pytest.mark.parametrize("hot_degree", [10_000, 15])
def test_subset_of_every_size(spark, order, hot_degree):
    pairs = random_graph(4, n=70, m=400, hubs=2)
    expect = brute(pairs)
    for k in (1, 5, 35):
        nodes = spark.createDataFrame([(i * 2,) for i in range(k)], "id BIGINT")
        got = G.triangle_counts(edges(spark, pairs), nodes=nodes, order=order, hot_degree=hot_degree)
        assert dict(rows(got)) == {i: n for i, n in expect.items() if i in range(0, 2 * k, 2)}


def test_what_a_subset_shuffles_follows_it(spark):
    """Ids that edges carry to their second corner: all of the graph's, and those of a few vertices."""
    import random as r
    gen = r.Random(6)
    e = G._stored(edges(spark, [(gen.randrange(400), gen.randrange(400)) for _ in range(12_000)]), "edges")
    carried = []
    for k in (400, 4):
        wanted = G._stored(spark.range(k), "wanted")
        seen = []
        real = G.hotkeys.salted_join
        try:
            G.hotkeys.salted_join = lambda big, *rest: (seen.append(big) or real(big, *rest))
            G._corners(e, "src", "dst", "id", False, 10_000, 1000, wanted=wanted)
        finally:
            G.hotkeys.salted_join = real
        carried.append(seen[-1].agg(F.sum(F.size("nu"))).first()[0])
    assert carried[1] < carried[0] / 10


def test_copies_of_edges_travel_packed(spark):
    """What is shuffled for the tasks is some bytes an edge, and comes out as it went in."""
    rng = random.Random(4)
    canon = G._stored(G.canonical_edges(edges(spark, [(rng.randrange(20_000), rng.randrange(20_000)) for _ in range(60_000)])), "canon")
    c = 3
    packed = colours.packed_edges(canon.coalesce(1), c, chunk=25_000).collect()
    plain = colours.coloured_edges(canon, c)
    assert sum(r["n"] for r in packed) == plain.count()
    assert sum(len(r["data"]) for r in packed) < 5 * plain.count()
    kind = pa.int64()
    out = [(r["triple"], *e, r["ca"], r["cb"]) for r in packed for e in zip(*(x.tolist() for x in colours.unpack_block(r["data"], r["n"], kind)))]
    low_first = [(t, *((a, b, x, y) if x <= y else (b, a, y, x))) for t, a, b, x, y in rows(plain)]
    assert sorted(out) == sorted(low_first)


@pytest.mark.parametrize("kind, of", [("BIGINT", lambda x: (-1) ** x * (x << 57) + x), ("INT", lambda x: 2 ** 31 - 1 - x), ("STRING", lambda x: f"v{x}")])
def test_ids_of_any_type_and_size(spark, kind, of):
    pairs = random_graph(6, n=40, m=200)
    e = spark.createDataFrame([(of(a), of(b)) for a, b in pairs], f"src {kind}, dst {kind}")
    got = G.triangle_counts(e, method="colours", task_edges=60)
    assert got.schema["id"].dataType == e.schema["src"].dataType
    assert dict(rows(got)) == {of(x): n for x, n in brute(pairs).items()}


def test_small_tasks_do_not_copy_edges_without_end(spark):
    canon = G._stored(G.canonical_edges(edges(spark, random_graph(7, n=200, m=3000))), "canon")
    parts = colours.Parts(canon, G.degrees(canon), G._stored, task_edges=20)
    assert colours.colour_count(canon.count(), 20, 4) > parts.colours == colours.COPIES
    assert parts.total().first()["total"] == sum(brute(random_graph(7, n=200, m=3000)).values()) // 3


def test_copies_are_shuffled_in_rounds(spark, monkeypatch):
    """Each triple is one round's, and all rounds together count every triangle."""
    pairs = random_graph(8, n=80, m=600)
    canon = G._stored(G.canonical_edges(edges(spark, pairs)), "canon")
    whole = {r["triple"]: r["n"] for r in colours.coloured_edges(canon, 5).groupBy("triple").agg(F.count("a").alias("n")).collect()}
    blocks = colours._colour_blocks(canon, 5)
    parts = [{r["triple"]: r["n"] for r in blocks.select(*colours._triples(5, i, 3), "n").groupBy("triple").agg(F.sum("n").alias("n")).collect()} for i in range(3)]
    assert all(parts) and sum(map(len, parts)) == len(whole) and {k: n for p in parts for k, n in p.items()} == whole
    monkeypatch.setattr(colours, "ROUND_COPIES", 2)
    expect = brute(pairs)
    assert dict(rows(G.triangle_counts(edges(spark, pairs), method="colours", task_edges=60))) == expect
    assert G.triangle_total(edges(spark, pairs), method="colours", task_edges=60).first()["total"] == sum(expect.values()) // 3
