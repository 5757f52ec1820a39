"""Every query against its SQL twin, and what the plans must not contain."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, compare
from demandkit.plans.queries import QUERIES

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def connection(sf_dir):
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return found


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_twin(spark, sf_dir, connection, name):
    outcome = compare(spark, connection, sf_dir, name)
    assert outcome.startswith(("ok", "rows only")), outcome


def test_entry(spark):
    assert entry_module.entry(spark).count() == 7


def test_every_twin_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(NAMES) <= set(entry_module.queries())


# only the linear solver and the stream state start Python workers
PYTHON_ALLOWED = re.compile(r"m3_|m4_|m6_|m1[0-6]_|m18_recursive_forecast_fitted|m21_|x\d_|m[789]_")


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("m7", "m8", "m9", "m10_cross_validation_forest", "m10_cross_validation_one", "m10_early", "m14_forest", "m14_search", "m15_tree", "x"))])
def test_plan_shape(spark, sf_dir, name):
    plan = entry_module.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    if not PYTHON_ALLOWED.match(name):
        assert "Python" not in plan and "InPandas" not in plan
    # a window without a partition key would pull the table into one task; the one exception
    # runs over the value histogram of ungrouped quantiles, bounded by its number of buckets
    for window in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        order_first = re.match(r"(\w+)#\d+L? (ASC|DESC)", window.strip())
        assert order_first is None or order_first.group(1) == "_b", window
    assert "CartesianProduct" not in plan
