"""Rows to topics as JSON messages."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.codec import as_text, encode_rows

TRANSACTIONS_TOPIC = "transactions"


def publish_transactions(records: DataFrame, topics, topic: str = TRANSACTIONS_TOPIC) -> None:
    """Transactions as messages of text fields, without a message key."""
    topics.write(encode_rows(as_text(records)), topic)


def publish_insight(
    insight: DataFrame, topics, topic: str, run_id: int | None = None, ignore_null_fields=True
) -> None:
    """An insight table as messages, one per row.

    Insight topics only grow. With a ``run_id`` (any number that rises from
    run to run) a last message tells how many rows the run has, so a reader
    can tell the latest whole table from earlier ones and from one cut short,
    and the run can be found without reading those before it.
    """
    messages = _stamped(insight, run_id, ignore_null_fields)
    if run_id is None:
        topics.write(messages, topic)
    else:
        topics.write_run(messages, topic, run_id)


def publish_insight_batch(insight: DataFrame, topics, topic: str, run_id: int) -> None:
    """The same from a micro-batch; a replay of the run replaces it where the topic can."""
    topics.write_batch(_stamped(insight, run_id, True), topic, run_id)


def new_run_id() -> int:
    """The time; give a number of your own where clocks of several machines are used."""
    return time.time_ns()


def first_run_id(spark: SparkSession, checkpoint: str) -> int:
    """The number that a stream's micro-batches are counted on from.

    Drawn once for a checkpoint and kept beside it, so a replayed batch has the
    number it had, and a query on a new checkpoint comes after the old one.
    """
    path = f"{checkpoint}-first-run"
    spark.createDataFrame([(new_run_id(),)], "run_id bigint").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).first()["run_id"]


def _stamped(insight, run_id, ignore_null_fields):
    """Messages of a run under a key of run and dimension value, so that one sent again can be told."""
    if run_id is None:
        return encode_rows(insight, ignore_null_fields)
    number = F.lit(run_id).cast("bigint").alias("run_id")
    end = insight.agg(F.count("*").alias("run_rows")).select(number, "run_rows")
    keyed = insight.select("*", number)
    dimension = F.col(insight.columns[0]).alias("of")
    rows = encode_rows(keyed, ignore_null_fields, key=F.to_json(F.struct("run_id", dimension)))
    return rows.unionAll(encode_rows(end, ignore_null_fields, key=F.to_json(F.struct("run_id", F.lit(True).alias("end")))))
