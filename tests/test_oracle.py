"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as ent
from larkspur import registry
from oracle_check import compare, duck

registry.load_all()
QUERIES = {name: fn for name, fn in ent.queries().items() if name in registry.QUERIES}
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


# Plan operators no registered query may use: cross joins / all-pairs, and Python row evaluation.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name} plan uses {bad}"
    msg, ok = compare(spark, con, name, lambda _s, _d: df, ORACLES.get(name), sf_dir)
    assert ok, msg


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["name", "device", "os", "browser"]
    assert df.count() > 0
