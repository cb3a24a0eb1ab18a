"""The join strategies a large cluster would use: with adaptive
broadcasting off every join that is not explicitly bounded is a shuffle
join.  Results must not change."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import clustering as CL
from lodestar.operators import graph as G
from lodestar.operators import split as S
from lodestar.sources.tables import FEATURES, POINT_KEY, part_graph, points_view


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("order", ["degree", "id"])
def test_triangles_with_shuffle_joins(no_broadcast, order):
    spark = no_broadcast
    e = part_graph(spark, SF_SMALL)
    assert G.triangle_total(e, "a", "b", order=order, canonical=True).first()["total"] == 125968
    c = G.triangle_counts(e, "a", "b", order=order, canonical=True)
    r = c.agg(F.sum("count"), F.min("count"), F.max("count"), F.count(F.lit(1))).first()
    assert tuple(r) == (377904, 521, 4261, 200)
    # and with hot vertices forced, mixing bounded broadcasts and shuffle joins
    assert G.triangle_total(e, "a", "b", order=order, canonical=True,
                            hot_degree=100, max_hot=40).first()["total"] == 125968


def test_points_lloyd_and_split_with_shuffle_joins(no_broadcast):
    spark = no_broadcast
    p = points_view(spark, SF_SMALL)
    _, sizes, _ = CL.lloyd_standardized(p, FEATURES, POINT_KEY, k=2, max_iters=3)
    assert sizes == [(0, 3107), (1, 2893)]
    out = S.with_tail_side(p.select(*POINT_KEY), POINT_KEY, 0.3)
    assert out.filter("is_train").count() == 4200


@pytest.fixture
def ansi_off(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("name", ["column_stats", "edges_cast", "lloyd_cluster_sizes", "split_hash",
                                  "synth_points", "triangle_total"])
def test_same_results_with_ansi_off(ansi_off, name):
    import __spark_entry__ as entry
    from oracle_compare import compare, duck
    r = compare(ansi_off, duck(SF_SMALL), name, SF_SMALL, entry.oracle_sql()[name])
    assert r["ok"], r
