"""Queries of ``llm.catalog`` that SQL can express against that SQL, on sf0.001."""

import pytest

from lodestar.llm import catalog
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, catalog.ORACLES[name])
    assert r["ok"], r
