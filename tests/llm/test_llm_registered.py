"""Registered queries against their SQL, and what holds for all of them."""

import pytest
from compare import compare, connect

import __spark_entry__ as registered
import corpus_pipeline
from ledgerlark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_all_operators_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14))
    assert "pipeline" in registered.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, con, name):
    frame, problems = compare(spark, con, SF_DIR, name)
    assert problems == []
    plan = frame._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["op2_pii", "op3_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_without_sql_gives_every_document(spark, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = frame.count()
    assert rows <= n if name in ("pipeline", "op5_decontaminate") else rows == n
