"""Cells of the wide-column detail table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.codec import number_text
from tillsight.schema import TRANSACTION_FIELDS

# The two column families and their qualifiers.
FAMILIES: dict[str, tuple[str, ...]] = {
    "transaction_data": (
        "user_id",
        "product_id",
        "category",
        "sub_category",
        "price",
        "quantity",
        "total_amount",
        "payment_method",
        "timestamp",
    ),
    "customer_data": (
        "user_device",
        "user_city",
        "user_age",
        "user_gender",
        "user_income",
        "fraud_label",
    ),
}


def cell_text(column) -> Column:
    """A value as cell text; NULL is the empty cell."""
    kind = TRANSACTION_FIELDS.get(column)
    text = number_text(column) if isinstance(kind, T.DoubleType) else F.col(column).cast("string")
    return F.coalesce(text, F.lit(""))


def cell_bytes(column) -> Column:
    """A value as UTF-8 cell bytes."""
    return cell_text(column).cast("binary")


def family_struct(family: str, cell=cell_bytes) -> Column:
    """One column family as a struct of cells."""
    return F.struct(*[cell(name).alias(name) for name in FAMILIES[family]]).alias(family)
