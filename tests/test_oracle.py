"""Every query of ``plans.catalog`` against its oracle SQL on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from lodestar.plans import catalog, oracle
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql_or_is_a_model():
    no_sql = set(catalog.QUERIES) - set(SQL)
    assert no_sql == {"kmeans_cluster_sizes", "kmeans_centers", "split_random", "forest_scores",
                      "forest_sampled_scores", "forest_metrics"}
    assert set(SQL) <= set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, SQL[name])
    assert r["ok"], r


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "count"] and df.count() == 200


def test_entry_point_without_the_llm_subpackage():
    code = "import sys; sys.modules['lodestar.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(catalog.QUERIES)), str(len(SQL))]
