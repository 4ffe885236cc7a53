"""One key holding a third of all rows must not leave its rows to one task."""

import pytest
from pyspark.sql import functions as F

from tillsight.operators.insights import fraud_by, one_pass
from tillsight.operators.scoring import score_auc
from tillsight.sources.warehouse import transactions

ROWS = 300_000


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """Warehouse tables in which one order, hence one customer, has a third of the lines."""
    folder = tmp_path_factory.mktemp("hot")
    lines = spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        (F.col("id") % 400).alias("l_partkey"),
        (F.col("id") % 90).alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") % 9000 + 100).cast("double").alias("l_extendedprice"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 600).alias("o_custkey")
    )
    customers = spark.range(600).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")
    )
    nations = spark.range(25).select(
        F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name")
    )
    parts = spark.range(400).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("B"), F.col("id") % 25).alias("p_brand"),
        F.concat(F.lit("T"), F.col("id") % 6).alias("p_type"),
    )
    tables = dict(lineitem=lines, orders=orders, customer=customers, nation=nations, part=parts)
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def as_on_a_cluster(spark):
    """Nothing small enough to broadcast, and skew seen at the size of a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_among_tasks(spark, hot_tables, as_on_a_cluster):
    rows = transactions(spark, hot_tables, ["transaction_id", "user_city", "category"])
    grouped = rows.groupBy("user_city", "category").count()
    assert "skew=true" in final_plan(grouped)
    assert grouped.agg(F.sum("count")).first()[0] == ROWS


def test_skewed_groups_shuffle_one_row_per_task(spark, hot_tables):
    rows = transactions(spark, hot_tables)
    plan = final_plan(fraud_by(rows, "user_id"))
    assert "partial_count" in plan
    hot = fraud_by(rows, "user_id").filter("user_id = '7'").first()
    assert hot.total_transactions >= ROWS // 3
    total = one_pass(rows).filter("dimension = 'user_city'").agg(F.sum("transaction_count"))
    assert total.first()[0] == ROWS


def test_many_distinct_scores_are_ranked_in_parallel(spark):
    rows = spark.range(ROWS).select(
        F.rand(1).alias("score"), (F.rand(2) < 0.2).cast("int").alias("label")
    )
    assert abs(score_auc(rows, "score", "label").first()[0] - 0.5) < 0.01
