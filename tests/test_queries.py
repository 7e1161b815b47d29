"""Every registered query against its SQL on the smallest data, and what its plan may not hold."""

import pytest
from parity import compare, duck

import __spark_entry__ as entry
from airshed.workload import registry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition, REPARTITION"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(registry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert not [w for w in FORBIDDEN if w in plan.split("== Physical Plan ==")[1]]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "date_id" in df.columns
