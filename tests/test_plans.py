"""Physical-plan properties the design relies on (checked on the plan text)."""


from conftest import SF_SMALL
from lodestar.operators import clustering as CL
from lodestar.operators import features as FT
from lodestar.operators import graph as G
from lodestar.plans import catalog
from lodestar.sources.tables import FEATURES, part_graph, points_view


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_scan_is_pruned_and_filtered(spark):
    p = plan(catalog.points_derive_filter(spark, SF_SMALL))
    li = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    # only the columns the query uses are read, nulls are filtered in the scan
    assert "l_extendedprice" not in li and "l_shipdate" not in li and "l_returnflag" not in li
    pushed = li.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(l_orderkey)" in pushed and "IsNotNull(l_discount)" in pushed
    assert "(l_discount#" in li.split("DataFilters: [")[1]  # arithmetic predicate evaluated in the scan


def test_no_static_broadcast_of_scans(spark):
    # static broadcast is off: a scan is never broadcast from its file size
    p = plan(G.triangle_total(part_graph(spark, SF_SMALL), "a", "b", canonical=True))
    for line in p.splitlines():
        if "BroadcastExchange" in line:
            raise AssertionError(line)


def test_lloyd_iteration_is_one_scan_and_partial_aggregate(spark):
    pts = points_view(spark, SF_SMALL).select(*FEATURES).cache()
    pts.count()
    a = CL.cluster_means(CL.assign_nearest(pts, FEATURES, [(1.0, 0.0, 0.0), (40.0, 0.1, 0.1)]), FEATURES)
    p = plan(a)
    assert "InMemoryTableScan" in p and "partial_avg" in p
    assert "parquet" not in p.split("InMemoryRelation")[0]  # no re-read of the source
    assert "PythonUDF" not in p and "BatchEvalPython" not in p
    pts.unpersist()


def test_triangle_plan_has_no_python_and_no_cartesian(spark):
    p = plan(G.triangle_counts(part_graph(spark, SF_SMALL), "a", "b", canonical=True))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_standardize_is_literals(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x DOUBLE")
    p = plan(FT.standardize(df, ["x"]))
    assert "Window" not in p and "Join" not in p  # statistics enter as literals
