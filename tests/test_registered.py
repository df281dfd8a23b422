"""Every registered query against its SQL, and the shape of every plan."""

import re

import pytest
from compare import compare, connect

import __spark_entry__ as registered
from ledgerlark import catalog

SF_DIR = "/root/testdata/sf0.001"
# A window whose first key is a sort key has no partition: all rows in one task.
UNPARTITIONED = re.compile(r"windowspecdefinition\([^,]* (ASC|DESC) NULLS (FIRST|LAST)")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).columns == ["Country", "Revenue", "RevenueShare_pct"]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql_and_plan_scales(spark, con, name):
    frame, problems = compare(spark, con, SF_DIR, name)
    assert problems == []
    plan = frame._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not UNPARTITIONED.search(plan)
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_scans_read_only_what_is_used(spark):
    frame = registered.queries()["uk_vs_others"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().toString()
    lineitem = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in lineitem.split(",")} == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
    }
    orders = registered.queries()["orders_by_filter"](spark, SF_DIR)
    assert "EqualNullSafe(o_orderstatus,F)" in orders._jdf.queryExecution().toString()
