from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.functions import hotkeys
from lodestar.operators import graph as G
from lodestar.sources.edges import cast_edges


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


FIXTURE = [(1, 2), (2, 3), (3, 1), (2, 1), (1, 2), (4, 4), (5, 6)]


@pytest.mark.parametrize("order", ["degree", "id"])
def test_fixture_counts(spark, order):
    c = G.triangle_counts(edges(spark, FIXTURE), order=order)
    assert rows(c) == [(1, 1), (2, 1), (3, 1), (4, 0), (5, 0), (6, 0)]
    assert G.triangle_total(edges(spark, FIXTURE), order=order).first()["total"] == 1


def test_vertices_and_canonical(spark):
    e = edges(spark, FIXTURE)
    assert [r[0] for r in rows(G.vertices(e))] == [1, 2, 3, 4, 5, 6]
    assert rows(G.canonical_edges(e)) == [(1, 2), (1, 3), (2, 3), (5, 6)]


@pytest.mark.parametrize("n", [3, 5, 7])
def test_complete_graph(spark, n):
    kn = list(combinations(range(1, n + 1), 2))
    c = G.triangle_counts(edges(spark, kn))
    per = (n - 1) * (n - 2) // 2
    assert rows(c) == [(v, per) for v in range(1, n + 1)]
    assert G.triangle_total(edges(spark, kn)).first()["total"] == n * (n - 1) * (n - 2) // 6


def test_star_and_bipartite_have_none(spark):
    star = [(0, i) for i in range(1, 20)]
    k33 = [(a, b) for a in (1, 2, 3) for b in (11, 12, 13)]
    for g in (star, k33):
        assert G.triangle_total(edges(spark, g)).first()["total"] == 0
        assert all(c == 0 for _, c in rows(G.triangle_counts(edges(spark, g))))


def test_hub_graph_matches_brute_force(spark):
    # a hub joined to everything plus a ring: every ring edge closes one
    # triangle with the hub
    n = 60
    ring = [(i, i % n + 1) for i in range(1, n + 1)]
    hub = [(0, i) for i in range(1, n + 1)]
    e = edges(spark, ring + hub + [(b, a) for a, b in ring])
    c = dict(rows(G.triangle_counts(e)))
    assert c[0] == n and all(c[i] == 2 for i in range(1, n + 1))
    assert G.triangle_total(e).first()["total"] == n


def test_sum_is_three_times_total_and_partition_independent(spark):
    import random
    rnd = random.Random(5)
    pairs = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(400)]
    e = edges(spark, pairs)
    total = G.triangle_total(e).first()["total"]
    s = G.triangle_counts(e).agg(F.sum("count")).first()[0]
    assert s == 3 * total
    # brute force
    und = {(min(a, b), max(a, b)) for a, b in pairs if a != b}
    adj = {}
    for a, b in und:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    brute = sum(1 for a, b in und for w in adj[a] & adj[b] if w > b)
    assert total == brute
    for p in (1, 7):
        assert G.triangle_total(e.repartition(p)).first()["total"] == brute
        assert G.triangle_total(e.repartition(p), order="id").first()["total"] == brute
    assert rows(G.total_from_counts(G.triangle_counts(e))) == [(brute,)]


def test_nodes_subset(spark):
    e = edges(spark, FIXTURE)
    nodes = spark.createDataFrame([(1,), (5,), (99,)], "id BIGINT")
    assert rows(G.triangle_counts(e, nodes=nodes)) == [(1, 1), (5, 0)]


def test_bad_ids(spark):
    raw = spark.createDataFrame([("1", "2"), ("x", "7"), ("3000000000", "1"), (" 2 ", "3")], "u STRING, v STRING")
    assert rows(cast_edges(raw, on_bad="drop")) == [(1, 2), (2, 3), (3000000000, 1)]
    assert cast_edges(raw, on_bad="null").filter("src IS NULL").count() == 1
    with pytest.raises(Exception):
        cast_edges(raw, on_bad="raise").collect()


@pytest.mark.parametrize("hot_degree,max_hot", [(2, 3), (5, 50), (0, 1)])
def test_hot_vertex_paths_match_brute_force(spark, hot_degree, max_hot):
    import random
    rnd = random.Random(11)
    # two hubs plus random edges: forces salted joins and adjacency lists of several blocks
    pairs = [(0, i) for i in range(1, 60)] + [(1, i) for i in range(2, 40)]
    pairs += [(rnd.randrange(60), rnd.randrange(60)) for _ in range(300)]
    e = edges(spark, pairs)
    und = {(min(a, b), max(a, b)) for a, b in pairs if a != b}
    adj = {}
    for a, b in und:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    brute_total = sum(1 for a, b in und for w in adj[a] & adj[b] if w > b)
    per = {v: 0 for p in pairs for v in p}
    for a, b in und:
        for w in adj[a] & adj[b]:
            if w > b:
                for x in (a, b, w):
                    per[x] += 1
    kw = dict(hot_degree=hot_degree, max_hot=max_hot)
    assert G.triangle_total(e, **kw).first()["total"] == brute_total
    assert dict(rows(G.triangle_counts(e, **kw))) == per
    hot, t, n_hot = G.hot_vertices(G.degrees(G.canonical_edges(e)), hot_degree, max_hot)
    assert n_hot <= max_hot and hot.count() == n_hot and t >= hot_degree


def test_hot_threshold_is_the_least_that_keeps_the_bound(spark):
    sizes = spark.createDataFrame([(s,) for s in [1, 2, 3, 4, 5, 8, 9, 1000, 2**40]], "s long")
    assert hotkeys.threshold(sizes, "s", 0) == (0, 9)
    assert hotkeys.threshold(sizes, "s", 3) == (3, 6)
    assert hotkeys.threshold(sizes, "s", 3, 4) == (8, 3)   # five are above 4
    assert hotkeys.threshold(sizes, "s", 0, 0) == (2**40, 0)
    assert hotkeys.threshold(sizes.filter("false"), "s", 0, 0) == (0, 0)


def test_part_graph_with_hot_vertices(spark):
    from conftest import SF_SMALL
    from lodestar.sources.tables import part_graph
    e = part_graph(spark, SF_SMALL)
    assert G.triangle_total(e, "a", "b", canonical=True, hot_degree=100, max_hot=40).first()["total"] == 125968
    c = G.triangle_counts(e, "a", "b", canonical=True, hot_degree=100, max_hot=40)
    assert c.agg(F.sum("count")).first()[0] == 377904


def test_part_graph_salted_equals_plain(spark):
    from conftest import SF_SMALL
    from lodestar.sources.tables import part_graph
    plain = part_graph(spark, SF_SMALL)
    # orders at sf0.001 have up to 7 parts: threshold 3 salts the big ones
    salted = part_graph(spark, SF_SMALL, hot_parts=3, max_hot=200)
    assert plain.count() == 8899
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


@pytest.mark.parametrize("order", ["degree", "id"])
def test_orders_with_hubs_at_low_ids(spark, order):
    # hubs have the lowest ids: plain id order would give them every neighbour
    n = 80
    pairs = [(0, i) for i in range(2, n)] + [(1, i) for i in range(2, n)] + [(i, i + 1) for i in range(2, n - 1)]
    e = edges(spark, pairs)
    # every path edge (i, i+1) closes a triangle with each hub; (0, 1) is no edge
    assert G.triangle_total(e, order=order, hot_degree=5, max_hot=4).first()["total"] == 2 * (n - 3)
    adj = G.adjacency(G.oriented_edges(G.canonical_edges(e), order, hot_degree=5, max_hot=4))
    assert max(len(r["nbrs"]) for r in adj.collect()) <= 5


@pytest.mark.parametrize("order", ["degree", "id"])
def test_empty_and_self_loop_only_graphs(spark, order):
    empty = edges(spark, [])
    assert G.triangle_total(empty, order=order).first()["total"] == 0
    assert G.triangle_counts(empty, order=order).count() == 0
    loops = edges(spark, [(1, 1), (2, 2)])
    assert G.triangle_total(loops, order=order).first()["total"] == 0
    assert rows(G.triangle_counts(loops, order=order)) == [(1, 0), (2, 0)]


def test_zero_rows_come_from_the_degrees(spark):
    """Vertices without a triangle are kept without a pass over all raw edges: only what the simple graph leaves out is read again."""
    pairs = [(1, 2), (2, 3), (3, 1), (1, 2), (2, 1), (4, 4), (5, None), (None, 6), (None, None), (7, 8), (8, 8)]
    e = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
    for kw in ({}, {"order": "id"}, {"method": "colours"}):
        counts = G.triangle_counts(e, **kw)
        assert rows(counts) == [(1, 1), (2, 1), (3, 1), (4, 0), (5, 0), (6, 0), (7, 0), (8, 0)]
        plan = counts._jdf.queryExecution().toString()
        logical = plan[plan.index("== Optimized Logical Plan =="):plan.index("== Physical Plan ==")]
        assert "(src" in logical and "NOT coalesce" in logical  # the raw edges only by this filter
    wanted = spark.createDataFrame([(1,), (4,), (7,), (99,)], "id BIGINT")
    assert rows(G.triangle_counts(e, nodes=wanted)) == [(1, 1), (4, 0), (7, 0)]


def test_raw_edges_are_made_in_one_pass(spark):
    from conftest import SF_SMALL
    from lodestar.sources.tables import messy_part_edges
    plan = messy_part_edges(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
