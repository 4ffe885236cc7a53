"""Insight tables: transactions grouped by one dimension.

Every measure is a sum, count, minimum or maximum (or a ratio of those), so
Spark combines rows before the shuffle and what moves is one row per group and
task, however unevenly the groups are filled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.buckets import age_group, income_group
from tillsight.functions.rates import is_fraud, percentage
from tillsight.schema import TRANSACTION_FIELDS


@dataclass(frozen=True)
class Measure:
    """An aggregate, the fields it reads, and its type."""

    expression: Callable[[], Column]
    reads: tuple[str, ...]
    type: T.DataType = T.LongType()


def _transactions() -> Column:
    """A row without an id is not counted, though its fraud mark is."""
    return F.count("transaction_id")


def _frauds() -> Column:
    return F.count_if(is_fraud())


def _amount(aggregate) -> Measure:
    return Measure(lambda: aggregate("total_amount"), ("total_amount",), T.DoubleType())


MEASURES: dict[str, Measure] = {
    "transaction_count": Measure(_transactions, ("transaction_id",)),
    "avg_transaction_amount": _amount(F.avg),
    "max_transaction_amount": _amount(F.max),
    "min_transaction_amount": _amount(F.min),
    "fraud_count": Measure(_frauds, ("fraud_label",)),
    "total_transactions": Measure(_transactions, ("transaction_id",)),
    "fraud_percentage": Measure(
        lambda: percentage(_frauds(), _transactions()),
        ("transaction_id", "fraud_label"),
        T.DoubleType(),
    ),
}


def _aggregates(names) -> list[Column]:
    return [MEASURES[name].expression().alias(name) for name in names]


# Dimensions that are computed, with the field they come from.
DERIVED = {"age_group": "user_age", "income_group": "user_income"}

FRAUD_MEASURES = ("fraud_count", "total_transactions", "fraud_percentage")
AMOUNT_MEASURES = (
    "avg_transaction_amount",
    "transaction_count",
    "max_transaction_amount",
    "min_transaction_amount",
)


@dataclass(frozen=True)
class Insight:
    """One insight table: topic, dimension, measures, and its chart series."""

    topic: str
    dimension: str
    measures: tuple[str, ...]
    series: dict[str, str] | None = None

    @property
    def reads(self) -> tuple[str, ...]:
        """The transaction fields a job must decode for this table."""
        fields = {DERIVED.get(self.dimension, self.dimension)}
        for name in self.measures:
            fields.update(MEASURES[name].reads)
        return tuple(name for name in TRANSACTION_FIELDS if name in fields)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.dimension, _dimension_type(self.dimension))]
            + [T.StructField(name, MEASURES[name].type) for name in self.measures]
        )

    def build(self, transactions: DataFrame) -> DataFrame:
        return summarize(transactions, self.dimension, self.measures)


def _counts(topic, dimension, labels="labels", values="values") -> Insight:
    series = {labels: dimension, values: "transaction_count"}
    return Insight(topic, dimension, ("transaction_count",), series)


def _fraud_rates(topic, dimension, labels, measures=FRAUD_MEASURES) -> Insight:
    series = {labels: dimension, "fraud_percentages": "fraud_percentage"}
    return Insight(topic, dimension, measures, series)


# Insight names, their topics, and the names of their series.
INSIGHTS: dict[str, Insight] = {
    "payment_method": _counts("payment_method_analytics", "payment_method"),
    "age_group": _counts("age_group_analytics", "age_group"),
    "category": Insight(
        "category_analytics",
        "category",
        AMOUNT_MEASURES,
        {
            "categories": "category",
            "transaction_counts": "transaction_count",
            "avg_amounts": "avg_transaction_amount",
        },
    ),
    "city": _counts("city_analytics", "user_city", "cities", "transaction_counts"),
    "device": _counts("device_analytics", "user_device"),
    "fraud": _fraud_rates("fraud_analytics", "category", "categories", ("fraud_percentage",)),
    "fraud_category": _fraud_rates("fraud_category", "category", "categories"),
    "fraud_payment": _fraud_rates("fraud_payment", "payment_method", "payment_methods"),
    "fraud_device": _fraud_rates("fraud_device", "user_device", "devices"),
    "fraud_city": _fraud_rates("fraud_city", "user_city", "cities"),
    "fraud_age": _fraud_rates("fraud_age", "age_group", "age_groups"),
    "fraud_income": _fraud_rates("fraud_income", "income_group", "income_groups"),
    "income": Insight("income_analytics", "user_income", ("avg_transaction_amount",)),
}

# "income" is left out by default, as most of its groups hold few transactions.
SALES_INSIGHTS = ("category", "payment_method", "age_group", "city", "device", "fraud")
FRAUD_INSIGHTS = tuple(name for name in INSIGHTS if name.startswith("fraud_"))


def insight(name: str) -> Insight:
    """The insight called ``name``."""
    try:
        return INSIGHTS[name]
    except KeyError:
        raise ValueError(f"unknown insight {name!r}, expected one of {sorted(INSIGHTS)}") from None


def fields_for(names) -> tuple[str, ...]:
    """The transaction fields needed for several insights together."""
    wanted = {field for name in names for field in insight(name).reads}
    return tuple(field for field in TRANSACTION_FIELDS if field in wanted)


def _dimension_type(dimension: str) -> T.DataType:
    return TRANSACTION_FIELDS.get(dimension, T.StringType())


def _dimension_column(dimension: str) -> Column:
    computed = {"age_group": age_group, "income_group": income_group}
    return computed[dimension]() if dimension in computed else F.col(dimension)


def summarize(transactions: DataFrame, dimension: str, measures) -> DataFrame:
    """One row per value of ``dimension``; NULL is a value of its own."""
    return transactions.groupBy(_dimension_column(dimension).alias(dimension)).agg(
        *_aggregates(measures)
    )


def fraud_by(transactions: DataFrame, dimension: str) -> DataFrame:
    """Fraud count, transaction count and fraud percentage per value of ``dimension``."""
    return summarize(transactions, dimension, FRAUD_MEASURES)


def total_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total_rows"))


def by_each(transactions: DataFrame, dimensions, fields, aggregates) -> DataFrame:
    """``aggregates`` of ``fields`` by each of the dimensions, from one scan: (dimension, key, ...).

    One grouping set per dimension. The sets' sizes add up, whereas a
    pre-aggregation over all dimensions at once would multiply them. The
    grouping flags tell a NULL key from a dimension outside the set.
    """
    inputs = transactions.select(*[_dimension_column(name).alias(name) for name in dimensions], *fields)
    grouped = inputs.groupingSets([[name] for name in dimensions], *dimensions).agg(
        F.coalesce(*[F.when(F.grouping(name) == 0, name) for name in dimensions]).alias("dimension"),
        *aggregates,
    )
    key = F.coalesce(*[F.col(name).cast("string") for name in dimensions])
    rest = [name for name in grouped.columns if name not in (*dimensions, "dimension")]
    return grouped.select("dimension", key.alias("key"), *rest)


def dimensions_of(names) -> list[str]:
    """The dimensions of several insights, each once."""
    return list(dict.fromkeys(insight(name).dimension for name in names))


def one_pass(transactions: DataFrame, names=tuple(INSIGHTS)) -> DataFrame:
    """Several insights from one scan: (dimension, key, measures)."""
    measures = list(dict.fromkeys(name for table in names for name in insight(table).measures))
    fields = dict.fromkeys(field for name in measures for field in MEASURES[name].reads)
    return by_each(transactions, dimensions_of(names), fields, _aggregates(measures))


def pick(combined: DataFrame, name: str) -> DataFrame:
    """One insight table out of the rows of ``one_pass``."""
    wanted = insight(name)
    return combined.filter(F.col("dimension") == wanted.dimension).select(
        F.col("key").cast(_dimension_type(wanted.dimension)).alias(wanted.dimension),
        *wanted.measures,
    )
