"""Insight tables that grow: partial aggregates that can be merged with those of later messages.

Sums, counts, minimums and maximums merge; averages and percentages are
computed from them at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.rates import is_fraud, percentage
from tillsight.operators.insights import INSIGHTS, by_each, dimensions_of

_READS = ("transaction_id", "total_amount", "fraud_label")


def _parts() -> list[Column]:
    return [
        F.count("transaction_id").alias("ids"),
        F.count_if(is_fraud()).alias("frauds"),
        F.count("total_amount").alias("amounts"),
        F.sum("total_amount").alias("amount"),
        F.max("total_amount").alias("largest"),
        F.min("total_amount").alias("smallest"),
    ]


_MERGED = {"ids": F.sum, "frauds": F.sum, "amounts": F.sum, "amount": F.sum, "largest": F.max, "smallest": F.min}


def partial_insights(transactions: DataFrame) -> DataFrame:
    """Partial aggregates of all insights, from one scan: (dimension, key, parts)."""
    fields = [name for name in _READS if name not in dimensions_of(INSIGHTS)]
    return by_each(transactions, dimensions_of(INSIGHTS), fields, _parts())


def merged_insights(one: DataFrame, other: DataFrame) -> DataFrame:
    """Partial aggregates of the messages of both; no message may be in both."""
    parts = [merge(name).alias(name) for name, merge in _MERGED.items()]
    return one.unionByName(other).groupBy("dimension", "key").agg(*parts)


def finished_insights(parts: DataFrame) -> DataFrame:
    """(dimension, key, measures), as one pass over all messages would give them."""
    ids, frauds = F.col("ids"), F.col("frauds")
    return parts.select(
        "dimension", "key",
        F.try_divide("amount", "amounts").alias("avg_transaction_amount"), ids.alias("transaction_count"),
        F.col("largest").alias("max_transaction_amount"), F.col("smallest").alias("min_transaction_amount"),
        frauds.alias("fraud_count"), ids.alias("total_transactions"), percentage(frauds, ids).alias("fraud_percentage"),
    )
