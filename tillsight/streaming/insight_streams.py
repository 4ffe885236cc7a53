"""Streams over the transactions topic."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillsight.functions.codec import decode_transactions
from tillsight.operators.detail import last_messages, refused_messages
from tillsight.operators.insights import fields_for, insight, one_pass, pick
from tillsight.operators.latest import arrival_order
from tillsight.operators.quality import judge_keys, judge_messages
from tillsight.schema import COLUMNS
from tillsight.sinks.batches import write_batch
from tillsight.sinks.detail_table import store_detail
from tillsight.sinks.publish import TRANSACTIONS_TOPIC, first_run_id, publish_insight_batch
from tillsight.sinks.versions import complete_versions
from tillsight.workspace import COMPRESSION, discard, stored

# An insight has few groups, so its state needs few partitions, whatever the
# cluster's setting for batch shuffles; each partition costs a task and a state
# store commit per trigger.
STATE_PARTITIONS = 8


def transaction_stream(
    spark: SparkSession,
    topics,
    columns=None,
    topic: str = TRANSACTIONS_TOPIC,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Typed transactions as a stream, optionally limited per trigger."""
    return decode_transactions(topics.read_stream(spark, topic, max_per_trigger), columns)


def start_insight(
    spark: SparkSession,
    source,
    target,
    name: str,
    checkpoint: str,
    max_per_trigger: int | None = None,
    available_now: bool = False,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """One insight table kept up to date in its topic.

    Complete mode: each trigger sends the whole table as a run of its own, so
    readers take the latest run.
    """
    wanted = insight(name)
    own = _session(spark, state_partitions)
    table = wanted.build(
        transaction_stream(own, source, wanted.reads, max_per_trigger=max_per_trigger)
    )
    return _start(own, table, target, {name: lambda batch: batch}, f"{checkpoint}/{wanted.topic}", available_now)


def start_insights(
    spark: SparkSession,
    source,
    target,
    names,
    checkpoint: str,
    max_per_trigger: int | None = None,
    available_now: bool = False,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """Several insight tables from one read of the topic."""
    own = _session(spark, state_partitions)
    rows = transaction_stream(own, source, fields_for(names), max_per_trigger=max_per_trigger)
    tables = {name: partial(pick, name=name) for name in names}
    return _start(own, one_pass(rows, names), target, tables, f"{checkpoint}/insights", available_now)


def start_decode(
    spark: SparkSession,
    source,
    path: str,
    checkpoint: str,
    max_per_trigger: int | None = None,
    available_now: bool = False,
    refused_path: str | None = None,
) -> StreamingQuery:
    """Typed transactions appended to Parquet as they arrive.

    With a ``refused_path``, messages that cannot be read or have no id go
    there with reason and raw value, and not to ``path`` as rows of NULLs. Both
    are then folders of batches, which ``read_batches`` reads; a batch that is
    run again replaces itself in both.
    """
    if refused_path is not None:
        messages = source.read_stream(spark, TRANSACTIONS_TOPIC, max_per_trigger)
        return _start_batches(spark, messages, _split_batch(path, refused_path), f"{checkpoint}/decode", available_now)
    rows = transaction_stream(spark, source, max_per_trigger=max_per_trigger)
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("compression", COMPRESSION)
        .option("checkpointLocation", f"{checkpoint}/decode")
    )
    return _trigger(writer, available_now).start()


def start_detail(
    spark: SparkSession,
    source,
    path: str,
    checkpoint: str,
    max_per_trigger: int | None = None,
    available_now: bool = False,
    refused_path: str | None = None,
) -> StreamingQuery:
    """The detail table kept up to date: each batch is merged into the key ranges it touches.

    The table keeps when each row's message arrived, so it is the state: late
    messages and repeats lose against the row that is there, and a batch that
    is run again changes nothing. No state is held for ids between batches. A
    batch writes the ranges it touches anew, so triggers should be far apart
    where ids are spread over the whole table. Refused messages go to batches
    at ``refused_path``, beside ``path`` by default.
    """
    refused_path = refused_path or f"{path}-refused"

    def merge(batch, number):
        judged = judge_keys(batch.withColumn("arrival", arrival_order()), keep=["arrival"])
        messages, kept = stored(last_messages(judged), "last-messages")
        write_batch(refused_messages(messages), refused_path, number)
        good = messages.filter("reason is null").select("transaction_id", "value", "arrival")
        has_version = bool(complete_versions(batch.sparkSession, path))
        store_detail(good, path, messages.count(), merged=has_version)
        discard(batch.sparkSession, kept)

    messages = source.read_stream(spark, TRANSACTIONS_TOPIC, max_per_trigger)
    return _start_batches(spark, messages, merge, f"{checkpoint}/detail", available_now)


def _split_batch(path, refused_path):
    def split(batch, number):
        # Read once for each table: kept in between, the records would be larger than the messages.
        write_batch(judge_keys(batch).filter("reason is not null").select("reason", "value"), refused_path, number)
        write_batch(judge_messages(batch).filter("reason is null").select(*COLUMNS), path, number)

    return split


def _start_batches(spark, messages, handle, checkpoint, available_now):
    """``handle(batch, number)`` for each batch, with the same number when it is run again."""
    first = first_run_id(spark, checkpoint)
    writer = messages.writeStream.foreachBatch(lambda batch, batch_id: handle(batch, first + batch_id)).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(writer, available_now).start()


def start_console(rows: DataFrame) -> StreamingQuery:
    """A stream shown on the console."""
    return rows.writeStream.outputMode("append").format("console").start()


def _session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of the stream's own, as its state has fewer partitions than other shuffles."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", state_partitions)
    return own


def _start(spark, table, target, tables, checkpoint, available_now):
    """Publishes, at each trigger, the tables that are made of the batch."""
    first = first_run_id(spark, checkpoint)

    def publish(batch, batch_id):
        batch.persist()
        try:
            for name, build in tables.items():
                publish_insight_batch(build(batch), target, insight(name).topic, first + batch_id)
        finally:
            batch.unpersist()

    writer = (
        table.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now).start()


def _trigger(writer, available_now):
    return writer.trigger(availableNow=True) if available_now else writer
