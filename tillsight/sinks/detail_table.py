"""The detail table as files of key ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.cells import FAMILIES, family_struct
from tillsight.operators.detail import ARRIVAL_COLUMN, detail_rows, detail_schema, parsed
from tillsight.sinks.ranged_store import Stored, dealt, merge_ranges, read_ranges, write_ranges


def store_detail(messages: DataFrame, path: str, expected: int, merged: bool) -> Stored:
    """The last message of each id as a new version, alone or merged with the one before.

    ``messages`` has (transaction_id, value, arrival), about ``expected`` rows.
    They are dealt to ranges as they are and parsed behind that, merged ones
    only if they stay: finding the ranges reads them once more.
    """

    kept = F.col("arrival").alias(ARRIVAL_COLUMN)
    if merged:
        keyed = messages.select(F.col("transaction_id").cast("binary").alias("row_key"), "value", kept)
        return merge_ranges(keyed, path, "row_key", ARRIVAL_COLUMN, detail_schema(), _with_cells)
    messages = dealt(messages, "transaction_id", expected)
    return write_ranges(detail_rows(parsed(messages.select("value", "arrival")), keep=[kept]), path, "row_key")


def _with_cells(merged: DataFrame) -> DataFrame:
    """Rows of the table as they are, and the cells of each message that was merged in."""
    before = [F.col(name).alias(f"_{name}") for name in FAMILIES]
    found = parsed(merged.select("range", "part", "row_key", ARRIVAL_COLUMN, "value", *before),
                   keep=["range", "part", "row_key", ARRIVAL_COLUMN, "value", *[f"_{name}" for name in FAMILIES]])
    return found.select("range", "part", "row_key", *[
        F.when(F.col("value").isNull(), F.col(f"_{name}")).otherwise(family_struct(name)).alias(name) for name in FAMILIES
    ], ARRIVAL_COLUMN)


def read_detail(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The detail table at ``path``: the last complete version, or the one in folder ``version``."""
    return read_ranges(spark, path, detail_schema(), version).drop(ARRIVAL_COLUMN)
