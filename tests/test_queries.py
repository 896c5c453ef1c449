"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tidemark.catalog import QUERIES, SQL as CATALOG_SQL
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = CATALOG_SQL
# Collections bounded by the number of topics, labels, or phrases in a chunk.
ALLOWED = {n: ("ObjectHashAggregate",) for n in ("tag_topics", "build_drug_graph", "phrase_query")}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ObjectHashAggregate"):
        assert unwanted not in plan or unwanted in ALLOWED.get(name, ()), plan
    got = df.toArrow()
    assert compare(got, con.sql(SQL[name]).to_arrow_table()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "text_md5", "t0_s", "t1_s"]
