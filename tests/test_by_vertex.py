"""Edge tables in buckets by vertex: right counts, and plans without the shuffles that the buckets spare."""

import random
import re

import pytest

from conftest import rows
from lodestar.operators import graph as G


def graph_of(spark, seed=4):
    rng = random.Random(seed)
    pairs = [(rng.randrange(50), rng.randrange(50)) for _ in range(300)] + [(0, x) for x in range(1, 50)] + [(7, 7)]
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


def exchanges(df):
    """Keys of the shuffles in the plan before anything ran."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)


@pytest.fixture(scope="module")
def stored(spark):
    e = graph_of(spark)
    return e, spark.table(G.store_by_vertex(e, buckets=4))


def test_degrees_and_id_adjacency_need_no_shuffle(stored):
    e, both = stored
    assert exchanges(G.degrees_by_vertex(both)) == [] and exchanges(G.adjacency(both.where("u < v"))) == []
    assert rows(G.degrees_by_vertex(both)) == rows(G.degrees(G.canonical_edges(e)))
    # What goes to a neighbour is shuffled once, the neighbour's list is not.
    assert exchanges(G.corners_by_vertex(both, "id")) == ["v"]


def test_degree_order_sends_degrees_once(stored):
    _, both = stored
    assert exchanges(G._ranked_by_vertex(both, "degree")) == ["to"]


@pytest.mark.parametrize("order", ["id", "degree"])
def test_counts_and_total(stored, order):
    e, both = stored
    expect = [r for r in rows(G.triangle_counts(e))]
    assert rows(G.triangle_counts_by_vertex(both, order)) == expect
    assert G.triangle_total_by_vertex(both, order).first()["total"] == sum(c for _, c in expect) // 3


def test_empty_graph(spark):
    both = spark.table(G.store_by_vertex(spark.createDataFrame([(1, 1), (None, 2)], "src BIGINT, dst BIGINT"), buckets=4))
    assert both.count() == 0 and G.triangle_total_by_vertex(both).first()["total"] == 0 and rows(G.triangle_counts_by_vertex(both)) == []
    with pytest.raises(ValueError):
        G.corners_by_vertex(both, "name")
