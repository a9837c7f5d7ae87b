"""Every registered query: its plan, and its result against the SQL."""

import os
import re

import duckdb
import pytest

from __spark_entry__ import entry
from workload.base import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Nodes that a plan must not contain: pairs of everything, and Python outside tree models.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "MapInArrow")
PYTHON_ALLOWED = {
    "tree_shap", "kernel_shap", "shap_additivity", "kernel_shap_linear", "kernel_shap_checked", "tree_shap_checked",
    "tree_reports_checked", "tree_global_checked",
}


def check_plan(name, plan):
    for node in FORBIDDEN:
        assert node not in plan, f"{node} in {name}"
    if name not in PYTHON_ALLOWED:
        assert not any(node in plan for node in PYTHON), f"Python in {name}"
    # A window over one partition would sort a whole table in a single task.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[+:\- ]Window \[", line):
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4]), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    check_plan(name, plan_of(df))
    sql = ORACLES.get(name)
    got = [tuple(row[c] for c in sorted(df.columns)) for row in df.collect()]
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(df.columns) == sorted(columns)
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry(spark).count() > 0


def test_literal_windows_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = QUERIES["make_labels"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1998-06-30" in plan
    assert "LessThanOrEqual(o_orderdate,1998-09-28" in plan
    plan = QUERIES["lookback_obs_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in plan
    # Neither prices nor flags are read for a count.
    assert "l_extendedprice" not in plan and "l_returnflag" not in plan
