"""Transaction records in headed CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.schema import COLUMNS


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All fields as text, found by the names in the header; an empty field is NULL.

    Columns may come in any order. Of the transaction fields those that the
    header does not name are NULL, and other columns are left out; a file that
    names none of them is an error. The files under one path share a header.
    Files are split across tasks. ``multi_line`` accepts line breaks inside
    quoted fields, at the price of one task per file.
    """
    rows = (
        spark.read.option("header", "true")
        .option("enforceSchema", "false")
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        .csv(path)
    )
    if not set(COLUMNS) & set(rows.columns):
        raise ValueError(f"no transaction field in the header of {path}: {rows.columns}")
    return rows.select(*[
        F.col(name) if name in rows.columns else F.lit(None).cast("string").alias(name)
        for name in COLUMNS
    ])
