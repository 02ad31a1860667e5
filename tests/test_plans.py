"""Query plans, and every query against its SQL on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from leafmill.plans.oracle import ORACLE
from leafmill.plans.queries import QUERIES

TABLES = "documents pages conversations events labels benchmark lineitem orders part".split()
# Operators whose answer is one row or one group by nature, or whose rows come from a model hook.
PYTHON_OK = {"describe_then_triage"}
ACTIONS = {n for n in QUERIES if n.startswith(("stream_", "chunk_"))} | {"rerun_documents", "status_files_round_trip", "status_store"}
SINGLE_OK = {"global_report_markdown"}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cells(rows):
    def cell(v):
        return "∅" if v is None else repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = cells(tuple(r[c] for c in columns) for r in df.collect())
    relation = db.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    want = cells(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ACTIONS))
def test_plan_stays_distributed(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    if name not in SINGLE_OK:
        assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_OK:
        assert "Python" not in plan and "InPandas" not in plan


def test_pushdown_and_pruning(spark, sf):
    import leafmill.operators.filters as L
    from leafmill.plans import bindings as B

    docs = B.table(spark, sf, "documents").withColumnRenamed("n_chars", "page")
    plan = L.filter_pages(docs.select("doc_id", "page"), "1-3,7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan
    files = QUERIES["source_manifest"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "lang" not in files


def test_entry(spark, sf):
    df = entry.entry(spark)
    assert df.count() > 0 and "percent_complete" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
