"""The one place where record, envelope and insight shapes are declared."""

from __future__ import annotations

from pyspark.sql import types as T

# The 16 fields of a transaction message, in message order, with
# the type each one gets after decoding. On the wire every field is text.
TRANSACTION_FIELDS: dict[str, T.DataType] = {
    "transaction_id": T.StringType(),
    "user_id": T.StringType(),
    "product_id": T.StringType(),
    "category": T.StringType(),
    "sub_category": T.StringType(),
    "price": T.DoubleType(),
    "quantity": T.IntegerType(),
    "total_amount": T.DoubleType(),
    "payment_method": T.StringType(),
    "timestamp": T.StringType(),
    "user_device": T.StringType(),
    "user_city": T.StringType(),
    "user_age": T.IntegerType(),
    "user_gender": T.StringType(),
    "user_income": T.IntegerType(),
    "fraud_label": T.IntegerType(),
}

COLUMNS = tuple(TRANSACTION_FIELDS)

# What a batch or streaming Kafka read returns; file-backed topics keep the
# same columns so that readers need not know which one they have.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def raw_schema(columns=None) -> T.StructType:
    """Transaction fields as nullable text, all of them or only ``columns``."""
    return T.StructType([
        T.StructField(name, T.StringType()) for name in _select(columns)
    ])


def typed_schema(columns=None) -> T.StructType:
    """Transaction fields with their decoded types."""
    return T.StructType([
        T.StructField(name, TRANSACTION_FIELDS[name]) for name in _select(columns)
    ])


def _select(columns):
    if columns is None:
        return COLUMNS
    unknown = set(columns) - set(COLUMNS)
    if unknown:
        raise ValueError(f"not transaction fields: {sorted(unknown)}")
    wanted = set(columns)
    return tuple(name for name in COLUMNS if name in wanted)
