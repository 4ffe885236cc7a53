"""What must not appear in the plans of queries that are a single DataFrame."""

import pytest

from tillsight.plans.catalog import QUERIES

WRITING = {"decode_roundtrip", "csv_roundtrip", "detail_upsert", "publish_insight",
           "insight_latest", "insight_latest_empty_run", "csv_reordered",
           "detail_quarantine", "detail_counts", "quarantine_rows", "score_auc", "fraud_model_predict", "fraud_model_auc"}
LAZY = sorted(
    name for name in QUERIES
    if name not in WRITING and not name.startswith(("series_", "stream_"))
)


@pytest.mark.parametrize("name", LAZY)
def test_plan(name, spark, small):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Cartesian", "NestedLoopJoin", "Window", "CollectLimit"):
        assert unwanted not in plan
    for column in ("l_discount", "l_tax", "l_returnflag", "c_acctbal", "p_name", "o_totalprice"):
        assert column not in plan


@pytest.mark.parametrize(
    "name, tables",
    [
        ("payment_method_distribution", {"lineitem"}),
        ("category_analytics", {"lineitem", "part"}),
        ("age_distribution", {"lineitem", "orders"}),
        ("city_transaction_count", {"lineitem", "orders", "customer", "nation"}),
        ("fraud_category", {"lineitem", "orders", "part"}),
    ],
)
def test_only_needed_tables_are_read(name, tables, spark, small):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    every = {"lineitem", "orders", "customer", "nation", "part"}
    assert {table for table in every if f"/{table}.parquet" in plan} == tables


def test_checks_read_only_needed_tables(spark, small):
    for name, tables in [("dq_duplicate_ids", 1), ("dq_amount_mismatch", 1), ("dq_range_violations", 2)]:
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(".parquet") == tables
