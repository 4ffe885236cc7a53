"""CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files, each with a header; quotes are doubled."""
    df.write.option("header", "true").option("escape", '"').csv(path)
