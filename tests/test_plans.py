"""The shape of the physical plans."""

import re

import pytest

from tidewell.checks.catalog import load
from tidewell.plans import corpus

QUERIES, _ = load()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["reco_topn", "customer_risk_score", "abnormal_transactions", "account_risk_features", "room_risk_features",
                                  "suspect_clusters", "reconcile_orders", "sanitize_documents", "cross_join_candidates", "daily_active"])
def test_no_products_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text


def test_chunking_is_narrow(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    text = plan(corpus.chunk_documents(docs))
    assert "MapInPandas" in text and "Exchange" not in text


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(QUERIES["filtered_count"](spark, small))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in schema and "ts:" not in schema
    assert "EqualTo(event_type,signup)" in text


def test_top_n_limits_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(QUERIES["rank_topn"](spark, small))


def test_sales_checks_reach_the_scans(spark, small):
    """No part of the validity stands in a join condition: rows are filtered below the joins."""
    text = QUERIES["sales_by_region"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if re.search(r"\bJoin\b", line)]
    assert joins and not any("try_" in line or "TRY" in line or "gettimestamp" in line for line in joins)
