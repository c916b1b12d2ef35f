"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from delayflow import registry
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# The library's own queries; those of optional parts are tested with them.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else repr(x)
    return None if x is None else str(x)


def _sorted(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in found), key=str)


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    assert len(set(df.columns)) == len(df.columns)
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    if key in ORACLES:
        twin = duck.execute(ORACLES[key])
        names = [d[0] for d in twin.description]
        assert sorted(names) == sorted(df.columns)
        assert _sorted(df.columns, found) == _sorted(names, twin.fetchall())
