"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from silverline.llm import queries
from workload.compare import connect, differences


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    with connect(sf_dir) as database:
        assert differences(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], database) == []


def test_all_are_registered():
    assert queries.QUERIES.keys() <= entry.queries().keys()
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
