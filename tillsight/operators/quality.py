"""Checks that the feed keeps the rules its producer promises."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.codec import apply_types, payload_text
from tillsight.operators.detail import has_key
from tillsight.schema import COLUMNS, raw_schema

# What the producer draws from.
SUB_CATEGORIES = {
    "Electronics": ["Smartphones", "Laptops", "Headphones", "Wearables"],
    "Clothing": ["Men_Shirts", "Women_Dresses", "Shoes", "Accessories"],
    "Home": ["Furniture", "Kitchen", "Decor", "Garden"],
    "Beauty": ["Skincare", "Makeup", "Fragrance", "Haircare"],
    "Sports": ["Gym_Equipment", "Outdoor", "Sportswear", "Footwear"],
    "Books": ["Fiction", "NonFiction", "Comics", "Textbooks"],
    "Automotive": ["Car_Accessories", "Motorcycle_Parts", "Car_Electronics"],
}
DOMAINS = {
    "payment_method": ["CreditCard", "DebitCard", "PayPal", "CashOnDelivery"],
    "user_device": ["Desktop", "Mobile", "Tablet"],
    "user_gender": ["M", "F", "Other"],
    "user_city": [
        "New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
        "San Antonio", "San Diego", "Dallas", "San Jose", "Austin",
    ],
}
RANGES = {
    "quantity": (1, 5),
    "user_age": (18, 70),
    "user_income": (20000, 200000),
    "price": (1.0, 999.99),
}

_UNREADABLE = "_unreadable"


def judge_messages(envelope: DataFrame) -> DataFrame:
    """Decoded messages with their ``value`` and a ``reason``, NULL for good ones.

    ``unreadable``: the payload is no JSON object. ``missing_id``: it has no id.
    Only a spoilt payload leaves text in the parser's error field, so a JSON
    object without any known field counts as missing its id.
    """
    schema = T.StructType(raw_schema().fields + [T.StructField(_UNREADABLE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE}
    parsed = F.from_json(payload_text(), schema, options)
    # Exploded rather than selected, so that filters do not parse once more.
    records = envelope.select("value", F.explode(F.array(parsed)).alias("record"))
    reason = F.when(
        F.col("record").isNull() | F.col(f"record.{_UNREADABLE}").isNotNull(), "unreadable"
    ).when(~F.coalesce(has_key(), F.lit(False)), "missing_id")
    flat = records.select("value", "record", "record.*").withColumn("reason", reason)
    return apply_types(flat).select("value", "reason", *COLUMNS)


def judge_keys(envelope: DataFrame, keep=()) -> DataFrame:
    """Messages with their id and the same ``reason``; nothing else of them is parsed."""
    schema = raw_schema(["transaction_id"]).add(_UNREADABLE, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE}
    parsed = F.from_json(payload_text(), schema, options)
    records = envelope.select(*keep, "value", F.explode(F.array(parsed)).alias("record"))
    flat = records.select(
        *keep, "value", "record.transaction_id", F.col(f"record.{_UNREADABLE}").alias(_UNREADABLE),
        F.col("record").isNull().alias("_no_record"),
    )
    reason = F.when(F.col("_no_record") | F.col(_UNREADABLE).isNotNull(), "unreadable").when(
        ~F.coalesce(has_key(), F.lit(False)), "missing_id"
    )
    return flat.withColumn("reason", reason).drop(_UNREADABLE, "_no_record")


def split_quarantine(envelope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good transactions, quarantined messages with reason and raw value)."""
    judged = judge_messages(envelope)
    good = judged.filter(F.col("reason").isNull()).select(*COLUMNS)
    return good, judged.filter(F.col("reason").isNotNull())


def amount_mismatches(transactions: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Rows whose total differs from price times quantity, in cents, by more than ``tolerance``."""
    expected = F.round(F.col("price") * F.col("quantity"), 2)
    return (
        transactions.withColumn("expected_amount", expected)
        .withColumn("difference", F.abs(F.col("total_amount") - F.col("expected_amount")))
        .filter(F.col("difference") > tolerance)
    )


def duplicate_ids(transactions: DataFrame) -> DataFrame:
    """Ids that occur more than once, with how often."""
    return (
        transactions.filter(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def outside_domain(transactions: DataFrame, columns, allowed: DataFrame) -> DataFrame:
    """Rows whose combination of ``columns`` is not a row of ``allowed``.

    A missing value is not a wrong one, so rows with a NULL among the columns
    pass. Spark broadcasts ``allowed`` if its size permits.
    """
    columns = list(columns)
    return transactions.dropna(subset=columns).join(allowed.select(*columns), columns, "left_anti")


def domain_violations(transactions: DataFrame, checks: dict[tuple[str, ...], DataFrame]) -> DataFrame:
    """(transaction_id, field, value) for each failed check, fields joined by ``/``.

    ``checks`` maps columns to a table of their allowed combinations. All are
    looked up in one pass over the transactions.
    """
    used = dict.fromkeys(name for columns in checks for name in columns)
    rows = transactions.select("transaction_id", *used)
    failures = []
    for number, (columns, allowed) in enumerate(checks.items()):
        known = f"known_{number}"
        listed = allowed.select(*columns).distinct().withColumn(known, F.lit(True))
        rows = rows.join(listed, list(columns), "left")
        complete = reduce(and_, [F.col(name).isNotNull() for name in columns])
        failure = F.struct(
            F.lit("/".join(columns)).alias("field"), F.concat_ws("/", *columns).alias("value")
        )
        failures.append(F.when(complete & F.col(known).isNull(), failure))
    return rows.select("transaction_id", F.inline(F.array_compact(F.array(*failures))))


def producer_domains(spark) -> dict[tuple[str, ...], DataFrame]:
    """The producer's own lists as input for ``domain_violations``."""
    checks = {
        (field,): spark.createDataFrame([(value,) for value in values], f"{field} string")
        for field, values in DOMAINS.items()
    }
    pairs = [(main, sub) for main, subs in SUB_CATEGORIES.items() for sub in subs]
    checks["category", "sub_category"] = spark.createDataFrame(
        pairs, "category string, sub_category string"
    )
    return checks


def range_violations(transactions: DataFrame, ranges=RANGES) -> DataFrame:
    """(field, low, high, checked, violations) per range, all from one scan."""
    checked = [F.count(name).alias(f"{name}_checked") for name in ranges]
    outside = [
        F.count_if(~F.col(name).between(low, high)).alias(f"{name}_outside")
        for name, (low, high) in ranges.items()
    ]
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
            F.col(f"{name}_checked").alias("checked"),
            F.col(f"{name}_outside").alias("violations"),
        )
        for name, (low, high) in ranges.items()
    ]
    return transactions.agg(*checked, *outside).select(F.inline(F.array(*rows)))
