"""Reading append-only data as tables: latest row per key, latest run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.codec import decode_rows
from tillsight.operators.insights import insight

# Envelope columns that tell in which order messages of a topic arrived.
ARRIVAL = ("timestamp", "partition", "offset")


def arrival_order() -> Column:
    return F.struct(*ARRIVAL).alias("arrival")


def latest_by_key(
    rows: DataFrame, key: str, arrival: str = "arrival", keep_arrival: bool = False
) -> DataFrame:
    """The row that arrived last for each ``key``, without the arrival column unless told to keep it.

    An aggregate instead of a ranking, so each task first reduces its own rows
    to one per key and a key that is repeated very often moves few rows.
    """
    fields = [name for name in rows.columns if name not in (key, arrival)]
    newest = [F.max_by(F.struct(*fields), F.col(arrival)).alias("newest")]
    kept = [arrival] if keep_arrival else []
    newest += [F.max(name).alias(name) for name in kept]
    return rows.groupBy(key).agg(*newest).select(key, "newest.*", *kept)


def read_insight(spark: SparkSession, topics, name: str, latest: bool = False) -> DataFrame:
    """An insight table back from its topic: all rows, or the last whole run's table.

    A message that a retry sent again has the key of the one before and counts
    once. Messages without a key all count.

    A run is whole when its last message is there and as many groups as that
    says, so a run that is being sent or was cut short is passed over, and an
    empty one counts. Within a run a group's latest row counts, as a write that
    was retried may have sent some twice. Messages without a run id are one
    run, older than all others. Where the topic can tell where its last run
    was sent to, only that run is read and not the topic's history.
    """
    wanted = insight(name)
    numbers = [T.StructField("run_id", T.LongType()), T.StructField("run_rows", T.LongType())]
    schema = T.StructType(wanted.schema.fields + numbers)
    columns = [*wanted.schema.names, "run_id"]
    narrowed = topics.last_run(spark, wanted.topic) if latest else None
    messages = (narrowed or topics).read(spark, wanted.topic)
    if not latest:
        keyed = messages.filter("key is not null").withColumn("arrival", arrival_order()).select("key", "value", "arrival")
        once = latest_by_key(keyed, "key").unionByName(messages.filter("key is null").select("key", "value"))
        return decode_rows(once, schema).filter("run_rows is null").select(*columns)
    rows = decode_rows(messages.withColumn("arrival", arrival_order()), schema, keep=["arrival"])
    keys = ["run_id", "is_end", wanted.dimension]
    marked = rows.withColumn("is_end", F.col("run_rows").isNotNull())
    fields = F.struct(*[name for name in marked.columns if name not in (*keys, "arrival")])
    # Kept beside the keys too: a filter on a key would move below the aggregate,
    # and the subquery could not share it.
    groups = marked.groupBy(*keys).agg(
        F.max_by(fields, "arrival").alias("newest"),
        F.max("run_id").alias("run"), F.max("is_end").alias("end"),
    ).select(*keys, "newest.*", "run", "end")
    whole = (
        groups.groupBy("run")
        .agg(F.count_if(~F.col("end")).alias("there"), F.max("run_rows").alias("needed"))
        .filter(F.col("there") >= F.col("needed"))
    )
    # The subquery reuses the aggregate above it, so both see one state of the topic.
    last_run = whole.agg(F.max("run")).scalar()
    found = groups.filter(~F.col("end") & F.col("run").eqNullSafe(last_run))
    return found.select(*columns)
