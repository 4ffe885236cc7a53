"""Insight tables in the shape charts take."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.insights import insight


def with_share(counts: DataFrame, value: str = "transaction_count") -> DataFrame:
    """Each row's percentage of the total, exact and to one decimal.

    The total is a scalar subquery, so no task sees all rows.
    """
    total = counts.agg(F.sum(value)).scalar()
    share = F.try_divide(F.col(value), total) * 100
    return counts.select("*", share.alias("share")).withColumn(
        "share_rounded", F.round("share", 1)
    )


def series(table: DataFrame, name: str) -> DataFrame:
    """An insight table as one row of parallel arrays, ordered by the first.

    Always one row, built by one task: a chart is as large as its table has
    groups. An empty table gives empty arrays.
    """
    wanted = insight(name)
    if wanted.series is None:
        raise ValueError(f"insight {name!r} has no chart")
    points = F.array_sort(F.array_agg(F.struct(*wanted.series.values())))
    return table.agg(points.alias("points")).select(*[
        F.col("points").getField(column).alias(label) for label, column in wanted.series.items()
    ])


def series_json(table: DataFrame, name: str) -> DataFrame:
    """The same as JSON documents."""
    return series(table, name).select(F.to_json(F.struct("*")).alias("value"))
