"""The registered queries that SQL can express, against their SQL."""

import os

import pytest

from monthgrid.llm import registry
from oracle import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.load()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLES))
def test_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_one_query_for_each_operator_and_the_pipeline():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14)) and "pipeline" in QUERIES
