import json

import pytest
from pyspark.sql import functions as F

from tillsight.functions.buckets import age_group, income_group
from tillsight.operators import shaping
from tillsight.operators.insights import (
    FRAUD_INSIGHTS,
    INSIGHTS,
    SALES_INSIGHTS,
    fields_for,
    fraud_by,
    insight,
    one_pass,
    pick,
)
from tillsight.sources.warehouse import transactions


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rounded(df):
    if "avg_transaction_amount" in df.columns:
        df = df.withColumn("avg_transaction_amount", F.round("avg_transaction_amount", 6))
    return sorted(df.collect(), key=str)


def test_age_group_edges(spark):
    ages = [-1, 0, 19, 20, 29, 30, 39, 40, 49, 50, 70, None]
    df = spark.createDataFrame([(age,) for age in ages], "user_age int")
    assert [row[0] for row in df.select(age_group()).collect()] == [
        "Under 20", "Under 20", "Under 20", "20-29", "20-29", "30-39", "30-39", "40-49", "40-49",
        "50+", "50+", None,
    ]


def test_income_group_edges(spark):
    incomes = [0, 19999, 20000, 59999, 60000, 99999, 100000, 139999, 140000, None]
    df = spark.createDataFrame([(income,) for income in incomes], "user_income int")
    assert [row[0] for row in df.select(income_group()).collect()] == [
        "Under 20k", "Under 20k", "20k-59k", "20k-59k", "60k-99k", "60k-99k", "100k-139k",
        "100k-139k", "140k+", None,
    ]


def test_group_without_ids_has_no_percentage(spark):
    rows = spark.createDataFrame(
        [("a", None, 1), ("a", None, 0), ("b", "1", 1), ("b", "2", None), (None, "3", 0)],
        "category string, transaction_id string, fraud_label int",
    )
    found = {row.category: tuple(row)[1:] for row in fraud_by(rows, "category").collect()}
    assert found == {"a": (1, 0, None), "b": (1, 2, 50.0), None: (0, 1, 0.0)}


@pytest.mark.parametrize("name", sorted(INSIGHTS))
def test_one_pass_equals_separate(spark, small, name):
    rows = transactions(spark, small)
    separate = insight(name).build(rows)
    assert separate.schema.names == insight(name).schema.names
    assert [f.dataType for f in separate.schema] == [f.dataType for f in insight(name).schema]
    assert rounded(pick(one_pass(rows), name)) == rounded(separate)


def test_one_pass_reads_the_source_once(spark, small):
    plan = executed(one_pass(transactions(spark, small)))
    assert plan.count("lineitem.parquet") == 1
    assert "partial_count" in plan and "Expand" in plan


def test_groups_are_combined_before_the_shuffle(spark, small):
    wanted = insight("fraud_category")
    plan = executed(wanted.build(transactions(spark, small, wanted.reads)))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(category")
    assert "l_discount" not in plan and "customer.parquet" not in plan


def test_fields_are_those_of_the_measures():
    assert insight("payment_method").reads == ("transaction_id", "payment_method")
    assert insight("fraud_age").reads == ("transaction_id", "user_age", "fraud_label")
    assert "user_id" not in fields_for(INSIGHTS)


def test_names():
    assert len([name for name in INSIGHTS if INSIGHTS[name].series]) == 12
    assert len(SALES_INSIGHTS) == len(FRAUD_INSIGHTS) == 6
    with pytest.raises(ValueError, match="unknown insight"):
        insight("weather")


def test_shares_add_up(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2), (None, 5)], "k string, transaction_count bigint")
    found = {row.k: (row.share, row.share_rounded) for row in shaping.with_share(counts).collect()}
    assert found == {"a": (12.5, 12.5), "b": (25.0, 25.0), None: (62.5, 62.5)}


def test_share_of_nothing_is_null(spark):
    counts = spark.createDataFrame([("a", 0)], "k string, transaction_count bigint")
    assert shaping.with_share(counts).first().share is None


def test_series_arrays_stay_parallel(spark):
    table = spark.createDataFrame(
        [("b", 2.0, 20), (None, 3.0, 30), ("a", 1.0, 10)],
        "category string, avg_transaction_amount double, transaction_count bigint",
    )
    row = shaping.series(table, "category").first()
    assert row.asDict() == {
        "categories": [None, "a", "b"],
        "transaction_counts": [30, 10, 20],
        "avg_amounts": [3.0, 1.0, 2.0],
    }
    text = shaping.series_json(table.filter("category is not null"), "category").first().value
    assert json.loads(text) == {
        "categories": ["a", "b"], "transaction_counts": [10, 20], "avg_amounts": [1.0, 2.0]
    }


def test_series_of_unknown_or_chartless_insight(spark):
    table = spark.createDataFrame([(1, 2.0)], "user_income int, avg_transaction_amount double")
    with pytest.raises(ValueError):
        shaping.series(table, "weather")
    with pytest.raises(ValueError):
        shaping.series(table, "income")


def test_series_is_one_row_at_any_size(spark):
    table = spark.range(150_000).select(
        F.col("id").cast("string").alias("payment_method"), F.col("id").alias("transaction_count")
    )
    rows = shaping.series(table.repartition(5), "payment_method").collect()
    assert len(rows) == 1 and len(rows[0].labels) == 150_000
    assert rows[0].labels == sorted(rows[0].labels)
    assert all(label == str(value) for label, value in zip(rows[0].labels, rows[0].values))


def test_series_of_an_empty_table(spark):
    table = spark.createDataFrame([], "payment_method string, transaction_count bigint")
    assert shaping.series(table, "payment_method").collect()[0].asDict() == {"labels": [], "values": []}
