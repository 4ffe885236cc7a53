"""Transactions derived from the tables of a sales warehouse.

One row per line item, with its order, customer, nation and part. The
definition uses whole-number arithmetic and single double operations, so any
SQL engine gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.risk import RiskRules, rule_risk
from tillsight.schema import COLUMNS, typed_schema

# The rule set with a price threshold and category names that occur here.
WAREHOUSE_RULES = RiskRules(price_above=2000, risky_categories=("PROMO", "LARGE"))


def transactions(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """The transaction columns, typed; all 16, or only ``columns``.

    Dimensions are looked up by their unique keys and no line item is lost, so
    a lookup that none of the columns needs is left out of the plan.
    """
    wanted = typed_schema(columns).names
    return _projected(spark, folder, wanted).select(*wanted)


def dirty_transactions(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """The same rows with faults for the quality checks.

    Ids are shortened until some repeat, some are missing, and some totals are
    off by one. ``unreadable`` marks rows whose payload is to be junk.
    """
    wanted = typed_schema(columns).names
    faults = {
        "transaction_id": F.when(
            F.col("l_orderkey") % 223 != 0, F.concat_ws("-", "l_orderkey", "l_linenumber")
        ),
        "total_amount": F.col("total_amount")
        + F.when(F.col("l_partkey") % 113 == 0, 1.0).otherwise(0.0),
    }
    rows = _projected(spark, folder, wanted)
    return rows.withColumns({
        **{name: fault for name, fault in faults.items() if name in wanted},
        "unreadable": F.col("l_orderkey") % 211 == 0,
    }).select(*wanted, "unreadable")


def chargebacks(rows: DataFrame) -> DataFrame:
    """Every fraudulent transaction once more, with its amount taken back."""
    return rows.filter(F.col("fraud_label") == 1).withColumn("total_amount", F.lit(0.0))


# Fields that need a lookup; all others come from the line item itself.
_FROM_ORDERS = {"user_id", "user_device", "user_age", "user_gender", "user_income"}
_FROM_CUSTOMERS = {"user_city"}
_FROM_PARTS = {"category", "sub_category"}
_RISK_INPUTS = {"price", "payment_method", "user_age", "user_income", "category"}


def _projected(spark: SparkSession, folder: str, wanted) -> DataFrame:
    """Line items with every ``wanted`` transaction field added."""
    fields = set(wanted)
    if "fraud_label" in fields:
        fields |= _RISK_INPUTS
    definitions = _definitions()
    rows = _looked_up(spark, folder, fields).withColumns({
        name: column for name, column in definitions.items() if name in fields
    })
    if "fraud_label" not in fields:
        return rows
    draw = (
        F.col("l_orderkey") * 31
        + F.col("l_partkey") * 17
        + F.col("l_suppkey") * 7
        + F.col("l_linenumber")
    ) % 100
    caught = draw < rule_risk(WAREHOUSE_RULES)
    return rows.withColumn("fraud_label", F.when(caught, 1).otherwise(0))


def _looked_up(spark: SparkSession, folder: str, fields: set[str]) -> DataFrame:
    """Line items with the dimensions that ``fields`` need.

    Customer and nation are put on orders first, so line items take part in
    two joins at most. Which sides are broadcast is left to Spark's size
    checks, and skewed keys to its adaptive skew join.
    """

    def table(name, *columns):
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    def lookup(rows, dimension, key, other):
        return rows.join(dimension, F.col(key) == F.col(other), "left")

    rows = table(
        "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_shipdate",
    )
    if fields & (_FROM_ORDERS | _FROM_CUSTOMERS):
        orders = table("orders", "o_orderkey", "o_custkey")
        if fields & _FROM_CUSTOMERS:
            customers = table("customer", "c_custkey", "c_nationkey")
            nations = table("nation", "n_nationkey", "n_name")
            customers = lookup(customers, nations, "c_nationkey", "n_nationkey")
            orders = lookup(orders, customers, "o_custkey", "c_custkey")
        rows = lookup(rows, orders, "l_orderkey", "o_orderkey")
    if fields & _FROM_PARTS:
        parts = table("part", "p_partkey", "p_brand", "p_type")
        rows = lookup(rows, parts, "l_partkey", "p_partkey")
    return rows


def _definitions() -> dict[str, Column]:
    order, part, buyer = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    return {
        "transaction_id": F.concat_ws(
            "-", order, "l_linenumber", part, "l_suppkey"
        ),
        "user_id": buyer.cast("string"),
        "product_id": F.concat(F.lit("PID_"), F.lpad(part.cast("string"), 8, "0")),
        "category": F.when(part % 101 != 0, F.col("p_type")),
        "sub_category": F.col("p_brand"),
        "price": F.try_divide("l_extendedprice", "l_quantity"),
        "quantity": F.col("l_quantity").cast("int"),
        "total_amount": F.col("l_extendedprice"),
        "payment_method": _pick(order, "CreditCard", "DebitCard", "PayPal", "CashOnDelivery"),
        "timestamp": F.col("l_shipdate").cast("string"),
        "user_device": _pick(buyer, "Desktop", "Mobile", "Tablet"),
        "user_city": F.col("n_name"),
        "user_age": F.when(buyer % 97 != 0, (18 + buyer * 7 % 53).cast("int")),
        "user_gender": _pick(buyer, "Other", "M", "F", "M", "F"),
        "user_income": (10000 + buyer * 7919 % 190001).cast("int"),
    }


def _pick(key: Column, *names: str) -> Column:
    """The name at position ``key mod len(names)``."""
    return F.get(F.array(*map(F.lit, names)), (key % len(names)).cast("int"))
