"""The detail table: one wide row of text cells per transaction id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.cells import FAMILIES, cell_bytes, cell_text, family_struct
from tillsight.functions.codec import apply_types, decode_rows
from tillsight.operators.latest import ARRIVAL
from tillsight.schema import raw_schema

#: When each row's message arrived; tells which row stays when a later load is merged in.
ARRIVAL_COLUMN = "_arrival"


def has_key() -> Column:
    """Rows without an id have no place in a keyed table."""
    return F.col("transaction_id").isNotNull() & (F.col("transaction_id") != "")


def last_messages(judged: DataFrame) -> DataFrame:
    """The last good message of each id and every refused one, from one pass over judged messages.

    (transaction_id, reason, value, arrival, messages), where ``messages`` is
    how many the row stands for. Messages are reduced as they are; refused
    ones are told apart by arrival and payload, so each keeps its row.
    """
    refused = F.struct(F.col("arrival").alias("at"), F.xxhash64("value").alias("said"))
    each = F.when(F.col("reason").isNotNull(), refused)
    return (
        judged.withColumn("_each", each)
        .groupBy("transaction_id", "reason", "_each")
        .agg(F.max_by("value", "arrival").alias("value"), F.max("arrival").alias("arrival"), F.count("*").alias("messages"))
        .drop("_each")
    )


def parsed(messages: DataFrame, keep=("arrival",)) -> DataFrame:
    """Good messages to typed transactions, with the columns ``keep`` in front."""
    return apply_types(decode_rows(messages, raw_schema(), keep))


def refused_messages(messages: DataFrame) -> DataFrame:
    """(reason, value, arrival), a row for each message that was refused."""
    bad = messages.filter("reason is not null")
    again = F.explode(F.array_repeat(F.lit(0), F.col("messages").cast("int"))).alias("_copy")
    return bad.select("reason", "value", "arrival", again).drop("_copy")


def detail_rows(transactions: DataFrame, keep=()) -> DataFrame:
    """Wide form: row key and one struct of cells per column family, then ``keep``."""
    return transactions.select(
        cell_bytes("transaction_id").alias("row_key"),
        *[family_struct(family) for family in FAMILIES],
        *keep,
    )


def detail_schema() -> T.StructType:
    """Columns of the detail table; ``ARRIVAL_COLUMN`` is for later merges and not for readers."""
    families = [
        T.StructField(family, T.StructType([T.StructField(name, T.BinaryType()) for name in names]))
        for family, names in FAMILIES.items()
    ]
    times = {"timestamp": T.TimestampType(), "partition": T.IntegerType(), "offset": T.LongType()}
    arrival = T.StructType([T.StructField(name, times[name]) for name in ARRIVAL])
    return T.StructType([T.StructField("row_key", T.BinaryType()), *families, T.StructField(ARRIVAL_COLUMN, arrival)])


def detail_cells(transactions: DataFrame) -> DataFrame:
    """Long form: (row_key, family, qualifier, value), as text."""
    cells = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(qualifier).alias("qualifier"),
            cell_text(qualifier).alias("value"),
        )
        for family, qualifiers in FAMILIES.items()
        for qualifier in qualifiers
    ]
    return transactions.select(
        cell_text("transaction_id").alias("row_key"), F.inline(F.array(*cells))
    )
