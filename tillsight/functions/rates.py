"""Fraud indicator and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_fraud(label="fraud_label") -> Column:
    return F.col(label) == 1


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, NULL where ``whole`` is 0 (ANSI mode would raise)."""
    return F.try_divide(part, whole) * 100
