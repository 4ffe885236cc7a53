"""The jobs a deployment schedules.

Each fixes at its start which messages it reads, so its tables and counts
describe the same ones while the topic goes on growing.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.codec import decode_transactions
from tillsight.operators import model
from tillsight.operators.detail import detail_rows, last_messages, parsed, refused_messages
from tillsight.operators.insights import (
    FRAUD_INSIGHTS,
    INSIGHTS,
    SALES_INSIGHTS,
    fields_for,
    insight,
    one_pass,
    pick,
)
from tillsight.operators.latest import arrival_order
from tillsight.operators.model import FraudModel
from tillsight.operators.partials import finished_insights, merged_insights, partial_insights
from tillsight.operators.quality import judge_keys
from tillsight.sinks.covered_store import read_covered, write_covered
from tillsight.sinks.detail_store import write_detail_store, write_version
from tillsight.sinks.detail_table import store_detail
from tillsight.sinks.publish import TRANSACTIONS_TOPIC, new_run_id, publish_insight
from tillsight.sinks.ranged_store import Stored
from tillsight.sinks.versions import last_version
from tillsight.workspace import cut_lineage, discard
from tillsight.workspace import stored as keep_table


def insight_job(spark: SparkSession, source, target, names, run_id: int | None = None):
    """Several insight tables published from one scan; returns them by name.

    The combined result is written out before it is split, so all tables
    describe the same state of the topic and none triggers another scan.
    """
    rows = decode_transactions(source.read(spark, TRANSACTIONS_TOPIC), fields_for(names))
    combined = cut_lineage(one_pass(rows, names), "insights")
    run_id = new_run_id() if run_id is None else run_id
    tables = {name: pick(combined, name) for name in names}
    for name, table in tables.items():
        publish_insight(table, target, insight(name).topic, run_id)
    return tables


def increment_job(
    spark: SparkSession, source, target, path: str, names=tuple(INSIGHTS), run_id: int | None = None
):
    """The same tables from the messages that are new since the job's last run; returns them by name.

    The folder ``path`` keeps, per version, partial aggregates of all insights
    and the messages they cover. A run reads what no complete version covers,
    merges it with the last one, and publishes. A run that fails before its
    version is complete has covered nothing, and one that fails after it is
    published by the next. A source with bounds is refused, as part of a
    message's file or partition would then count as covered.
    """
    if source.bounded:
        raise ValueError("new messages are found by what was covered; give no start or end")
    before = read_covered(spark, path)
    covered = before.positions if before else {}
    pinned = source.pinned(spark, TRANSACTIONS_TOPIC, covered)
    if before is None or before.is_behind(pinned.covers(TRANSACTIONS_TOPIC)):
        rows = decode_transactions(pinned.read(spark, TRANSACTIONS_TOPIC), fields_for(INSIGHTS))
        parts = partial_insights(rows)
        if before:
            parts = merged_insights(before.table, parts)
        before = write_covered(parts, path, pinned.covers(TRANSACTIONS_TOPIC))
    run_id = new_run_id() if run_id is None else run_id
    whole = finished_insights(before.table)
    tables = {name: pick(whole, name) for name in names}
    for name, table in tables.items():
        publish_insight(table, target, insight(name).topic, run_id)
    return tables


def sales_job(spark: SparkSession, source, target, run_id: int | None = None):
    return insight_job(spark, source, target, SALES_INSIGHTS, run_id)


def fraud_job(spark: SparkSession, source, target, run_id: int | None = None):
    return insight_job(spark, source, target, FRAUD_INSIGHTS, run_id)


def show(tables: dict[str, DataFrame], rows: int = 20) -> None:
    """The first rows of each table on the console, and how many more there are."""
    for name, table in tables.items():
        table.show(rows)
        left = table.count() - rows
        if left > 0:
            print(f"{name}: {left} more rows")


@dataclass(frozen=True)
class Load:
    """What a load did with the messages it read, and the rows of the version it added them to."""

    rows_read: int
    stored: int
    refused: int
    before: int = 0

    @property
    def replaced(self) -> int:
        """Messages and rows from before that a later one of the same id stands for."""
        return self.rows_read + self.before - self.stored - self.refused


def arrivals(spark: SparkSession, source) -> DataFrame:
    """Messages with their id, why they are refused if they are, and the order of arrival."""
    messages = source.read(spark, TRANSACTIONS_TOPIC).withColumn("arrival", arrival_order())
    return judge_keys(messages, keep=["arrival"])


def detail_job(
    spark: SparkSession, source, path: str | None = None, open_writer=None, refused_path: str | None = None
) -> Load:
    """The topic into the detail table, the last message per id.

    Into a new version of the table at ``path``, which ``read_detail`` reads,
    or into the store that ``open_writer`` connects to. Messages that cannot be
    read or have no id go to the table at ``refused_path`` (beside ``path`` by
    default) with reason and raw value.

    The topic is read and shuffled once: what it comes to, the last message of
    each id and the refused ones, is stored, and both tables and all counts are
    taken from there. Only these messages are parsed in full.

    From a source with a start bound, the messages are merged with the last
    complete version by their arrival. Only the key ranges that they fall into
    are written anew; the new version shares the files of all others. A table
    without a version is an error then, as it would hold a part only.
    """
    refused_path = refused_path or (path and f"{path}-refused")
    merged = source.has_start and open_writer is None
    if merged:
        last_version(spark, path)
    pinned = source.pinned(spark, TRANSACTIONS_TOPIC)
    messages, kept = keep_table(last_messages(arrivals(spark, pinned)), "last-messages")
    counts = messages.agg(
        F.sum("messages").alias("read"), F.count_if(F.col("reason").isNull()).alias("ids"),
        F.sum(F.when(F.col("reason").isNotNull(), F.col("messages"))).alias("refused"),
    ).first()
    if refused_path:
        write_version(refused_messages(messages), refused_path)
    good = messages.filter("reason is null").select("transaction_id", "value", "arrival")
    if open_writer is not None:
        ordered = parsed(good.select("value", "arrival")).drop("arrival").sortWithinPartitions("transaction_id")
        stored = Stored(write_detail_store(detail_rows(ordered), open_writer), 0)
    else:
        stored = store_detail(good, path, counts.ids, merged)
    discard(spark, kept)
    return Load(counts.read or 0, stored.rows, counts.refused or 0, stored.before)


class Training(NamedTuple):
    """The fitted model, its area on the test part, and what went in."""

    model: FraudModel
    area: DataFrame
    rows_read: int
    left_out: int


def training_job(
    spark: SparkSession, source, path: str, split=model.stable_split, unseen: str = "keep", missing: str = "drop"
) -> Training:
    """Trains on four fifths of the topic and saves the model.

    ``split`` may be ``model.random_split`` for a draw that varies with
    partitioning. ``unseen`` is what to do with a category that the training
    part lacks: ``keep`` gives all such values one index, ``skip`` leaves their
    rows out of the scores, ``error`` fails. ``missing`` is ``drop``, or
    ``keep`` to treat a missing category as such a value; rows without a
    number or label are left out either way.
    """
    messages = source.pinned(spark, TRANSACTIONS_TOPIC).read(spark, TRANSACTIONS_TOPIC)
    rows = decode_transactions(messages, model.MODEL_INPUTS)
    complete = model.complete_rows(rows, missing).withColumn("_draw", model.split_draw())
    complete = cut_lineage(complete, "model-inputs")
    training, test = split(complete)
    fitted = model.train(training.drop("_draw"), "keep" if missing == "keep" else unseen)
    model.save(fitted, path)
    area = model.area_under_roc(model.score(fitted, test.drop("_draw")))
    read = messages.count()
    return Training(fitted, area, read, read - complete.count())
