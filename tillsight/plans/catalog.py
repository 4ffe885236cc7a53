"""The registered queries: each operator on transactions from the warehouse tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.cells import FAMILIES, cell_text
from tillsight.functions.codec import (
    apply_types,
    as_text,
    decode_rows,
    decode_transactions,
    encode_rows,
)
from tillsight.operators import insights, model, quality, scoring, shaping
from tillsight.operators.detail import detail_cells
from tillsight.operators.latest import read_insight
from tillsight.operators.partials import finished_insights
from tillsight.plans import jobs
from tillsight.schema import typed_schema
from tillsight.sinks.batches import read_batches
from tillsight.sinks.covered_store import read_covered
from tillsight.sinks.csv_files import write_csv
from tillsight.sinks.detail_store import read_version
from tillsight.sinks.detail_table import read_detail
from tillsight.sinks.publish import TRANSACTIONS_TOPIC, publish_insight, publish_transactions
from tillsight.sources.csv_files import read_csv
from tillsight.sources.topics import FileTopics
from tillsight.sources.warehouse import (
    WAREHOUSE_RULES,
    chargebacks,
    dirty_transactions,
    transactions,
)
from tillsight.streaming import insight_streams as streams
from tillsight.workspace import cut_lineage, fresh_folder, shared_folder

# Engines add doubles in different orders. Averages are compared to this many
# decimals, and are rounded as decimals so that exact halves go the same way.
DECIMALS = 4

_feeds: dict[tuple[str, ...], FileTopics] = {}
_models: dict[tuple[str, ...], tuple] = {}


def _new_topics(spark: SparkSession) -> FileTopics:
    return FileTopics(fresh_folder(spark, "topics"))


def feed(spark: SparkSession, folder: str) -> FileTopics:
    """Topics with the transactions published, once per session and folder."""
    key = (shared_folder(spark), spark.sparkContext.applicationId, folder)
    if key not in _feeds:
        topics = _new_topics(spark)
        publish_transactions(transactions(spark, folder), topics)
        _feeds[key] = topics
    return _feeds[key]


def _rounded(df: DataFrame) -> DataFrame:
    if "avg_transaction_amount" not in df.columns:
        return df
    average = _as_decimal(F.col("avg_transaction_amount")).cast("double")
    return df.withColumn("avg_transaction_amount", average)


def _as_decimal(value):
    return F.round(value.cast("decimal(20,8)"), DECIMALS)


# Records in and out.


def decode_roundtrip(spark, folder):
    return decode_transactions(feed(spark, folder).read(spark, TRANSACTIONS_TOPIC))


def csv_roundtrip(spark, folder):
    path = fresh_folder(spark, "csv")
    write_csv(transactions(spark, folder), path)
    return apply_types(read_csv(spark, path))


def csv_reordered(spark, folder):
    """A file whose columns come backwards, one of them left out."""
    path = fresh_folder(spark, "csv")
    rows = transactions(spark, folder)
    write_csv(rows.select(*[name for name in reversed(rows.columns) if name != "user_city"]), path)
    return apply_types(read_csv(spark, path))


def typed_transactions(spark, folder):
    return apply_types(as_text(transactions(spark, folder)))


def decode_events_props(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    envelope = events.select("event_id", F.encode("props", "UTF-8").alias("value"))
    return decode_rows(envelope, T.StructType().add("k", T.IntegerType()), keep=["event_id"])


def total_rows(spark, folder):
    return insights.total_rows(transactions(spark, folder, ["transaction_id"]))


def cells(spark, folder):
    return detail_cells(transactions(spark, folder))


def cells_large(spark, folder):
    """Amounts above ten million and below a thousandth, made from the price."""
    rows = transactions(spark, folder, ["transaction_id", "price", "total_amount"])
    scaled = rows.select(
        "transaction_id",
        (F.col("price") * 1e6).alias("price"),
        (F.floor("price") / 1e7).alias("total_amount"),
    )
    return scaled.select("transaction_id", cell_text("price").alias("price"),
                         cell_text("total_amount").alias("total_amount"))


def detail_upsert(spark, folder):
    topics, path = _new_topics(spark), fresh_folder(spark, "detail")
    rows = transactions(spark, folder)
    publish_transactions(rows, topics)
    publish_transactions(chargebacks(rows), topics)
    jobs.detail_job(spark, topics, path)
    return _stored_text(spark, path)


def detail_incremental(spark, folder):
    """A full load, then one of the later messages alone."""
    topics, path = _new_topics(spark), fresh_folder(spark, "detail")
    rows = transactions(spark, folder)
    publish_transactions(rows, topics)
    jobs.detail_job(spark, topics, path)
    after = F.max("timestamp") + F.expr("interval 1 microsecond")
    since = topics.read(spark, TRANSACTIONS_TOPIC).agg(after.cast("string")).first()[0]
    publish_transactions(chargebacks(rows), topics)
    jobs.detail_job(spark, FileTopics(topics.root, since=since), path)
    return _stored_text(spark, path)


def _stored_text(spark, path):
    flat = [
        F.decode(f"{family}.{name}", "UTF-8").alias(name)
        for family, names in FAMILIES.items()
        for name in names
    ]
    stored = read_detail(spark, path)
    return stored.select(F.decode("row_key", "UTF-8").alias("row_key"), *flat)


def dirty_feed(spark: SparkSession, folder: str) -> FileTopics:
    """Topics with the faulty transactions published, some as junk; once per session and folder."""
    key = (shared_folder(spark), spark.sparkContext.applicationId, folder, "dirty")
    if key not in _feeds:
        rows = dirty_transactions(spark, folder)
        fields = F.struct(*[name for name in rows.columns if name != "unreadable"])
        value = F.when(F.col("unreadable"), "junk").otherwise(F.to_json(fields))
        topics = _new_topics(spark)
        topics.write(rows.select(value.alias("value")), TRANSACTIONS_TOPIC)
        _feeds[key] = topics
    return _feeds[key]


def detail_quarantine(spark, folder):
    """What a load of the faulty feed refuses."""
    path = fresh_folder(spark, "detail")
    jobs.detail_job(spark, dirty_feed(spark, folder), path)
    _, refused = quality.split_quarantine(read_version(spark, f"{path}-refused"))
    return refused.select(*_REFUSED)


def detail_counts(spark, folder):
    """What becomes of the messages of the faulty feed, in numbers."""
    load = jobs.detail_job(spark, dirty_feed(spark, folder), fresh_folder(spark, "detail"))
    counts = [(load.rows_read, load.stored, load.replaced, load.refused)]
    return spark.createDataFrame(counts, "rows_read bigint, stored bigint, replaced bigint, refused bigint")


_REFUSED = ["reason", "user_id", "product_id", "timestamp", "total_amount"]


def published(spark, folder):
    topics = _new_topics(spark)
    publish_insight(_build("fraud_category", spark, folder), topics, "fraud_category")
    return read_insight(spark, topics, "fraud_category").drop("run_id")


def insight_latest(spark, folder):
    """Two runs over different data; the second must come out alone."""
    topics, wanted = _new_topics(spark), insights.insight("fraud_category")
    for run_id, rows in enumerate([dirty_transactions, transactions]):
        table = wanted.build(rows(spark, folder, wanted.reads))
        publish_insight(table, topics, wanted.topic, run_id)
    return read_insight(spark, topics, "fraud_category", latest=True).drop("run_id")


def insight_latest_empty_run(spark, folder):
    """A run without groups after one with some: the latest table is empty."""
    topics, wanted = _new_topics(spark), insights.insight("fraud_category")
    rows = transactions(spark, folder, [*wanted.reads, "user_age"])
    publish_insight(wanted.build(rows), topics, wanted.topic, run_id=1)
    publish_insight(wanted.build(rows.filter("user_age > 1000")), topics, wanted.topic, run_id=2)
    latest = read_insight(spark, topics, "fraud_category", latest=True)
    every = read_insight(spark, topics, "fraud_category")
    latest_groups = latest.agg(F.count("*")).scalar()
    return every.agg(F.count("*").alias("all_groups")).select(
        latest_groups.alias("latest_groups"), "all_groups"
    )


# Insight tables and charts.


def _build(name, spark, folder):
    wanted = insights.insight(name)
    return wanted.build(transactions(spark, folder, wanted.reads))


def table(name, spark, folder):
    return _rounded(_build(name, spark, folder))


def insights_one_pass(spark, folder):
    fields = insights.fields_for(insights.INSIGHTS)
    return _rounded(insights.one_pass(transactions(spark, folder, fields)))


def insights_incremental_published(spark, folder):
    """Four runs, each after a part of the transactions was published, and one after nothing was."""
    topics, path = _new_topics(spark), fresh_folder(spark, "covered")
    rows = transactions(spark, folder)
    for part in range(4):
        publish_transactions(rows.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == part), topics)
        jobs.increment_job(spark, topics, topics, path, names=[])
    tables = jobs.increment_job(spark, topics, topics, path, names=["category", "fraud_category"])
    latest = [read_insight(spark, topics, name, latest=True).drop("run_id") for name in tables]
    long = [
        table.select(F.lit(name).alias("insight"), F.col("category").alias("key"), *[
            (F.col(measure) if measure in table.columns else F.lit(None)).cast(insights.MEASURES[measure].type).alias(measure)
            for measure in insights.MEASURES
        ])
        for name, table in zip(tables, latest)
    ]
    return _rounded(long[0].unionAll(long[1]))


def insights_incremental(spark, folder):
    """All insight tables after two runs, in long form."""
    topics, path = _new_topics(spark), fresh_folder(spark, "covered")
    rows = transactions(spark, folder)
    for part in range(2):
        publish_transactions(rows.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == part), topics)
        jobs.increment_job(spark, topics, topics, path, names=[])
    return _rounded(finished_insights(read_covered(spark, path).table))


def share(name, spark, folder):
    return shaping.with_share(_build(name, spark, folder))


def chart(name, spark, folder):
    """The arrays as text, numbers as decimals, since engines print doubles differently."""
    return _chart_text(shaping.series(_build(name, spark, folder), name))


def series_empty(spark, folder):
    """The chart of an insight over no transactions."""
    wanted = insights.insight("fraud_category")
    none = transactions(spark, folder, [*wanted.reads, "user_age"]).filter("user_age > 1000")
    return _chart_text(shaping.series(wanted.build(none), "fraud_category"))


def _chart_text(arrays):

    def text(field):
        is_double = isinstance(field.dataType.elementType, T.DoubleType)
        texts = F.transform(
            field.name, lambda value: (_as_decimal(value) if is_double else value).cast("string")
        )
        return F.array_join(texts, "|", "NULL").alias(field.name)

    return arrays.select(*[text(field) for field in arrays.schema])


# Risk and quality.

_RISK_FIELDS = [
    "transaction_id", "price", "payment_method", "user_age", "user_income", "category",
    "fraud_label",
]


def _with_risk(spark, folder):
    return scoring.with_risk(transactions(spark, folder, _RISK_FIELDS), WAREHOUSE_RULES)


def rule_risk_score(spark, folder):
    rows = _with_risk(spark, folder)
    return rows.select("transaction_id", "risk", "fraud_label")


def risk_calibration(spark, folder):
    rows = transactions(spark, folder, _RISK_FIELDS)
    return scoring.risk_calibration(rows, WAREHOUSE_RULES)


def score_auc(spark, folder):
    rows = _with_risk(spark, folder)
    area = scoring.score_auc(rows, "risk", "fraud_label")
    return area.select(F.round("area_under_roc", 8).alias("area_under_roc"))


def dq_amount_mismatch(spark, folder):
    fields = ["transaction_id", "total_amount", "price", "quantity"]
    found = quality.amount_mismatches(dirty_transactions(spark, folder, fields))
    return found.select(
        "transaction_id", "total_amount", "expected_amount",
        F.round("difference", DECIMALS).alias("difference"),
    )


def dq_domain_violations(spark, folder):
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    allowed = {
        ("user_city",): nations.filter("n_regionkey < 4").select(F.col("n_name").alias("user_city")),
        ("category", "sub_category"): parts.filter("p_type <> 'PROMO' OR p_brand < 'Brand#3'")
        .select(F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"))
        .distinct(),
    }
    for field, values in quality.DOMAINS.items():
        if field != "user_city":  # all but the last value, so that there is something to find
            rows = [(value,) for value in values[:-1]]
            allowed[field,] = spark.createDataFrame(rows, f"{field} string")
    fields = [
        "transaction_id", "user_city", "category", "sub_category", "payment_method", "user_device",
        "user_gender",
    ]
    return quality.domain_violations(dirty_transactions(spark, folder, fields), allowed)


def dq_duplicate_ids(spark, folder):
    return quality.duplicate_ids(dirty_transactions(spark, folder, ["transaction_id"]))


def dq_range_violations(spark, folder):
    return quality.range_violations(dirty_transactions(spark, folder, quality.RANGES))


def quarantine_rows(spark, folder):
    _, bad = quality.split_quarantine(dirty_feed(spark, folder).read(spark, TRANSACTIONS_TOPIC))
    return bad.select(*_REFUSED)


# Model.


def string_index_category(spark, folder):
    return model.frequency_index(transactions(spark, folder, ["category"]), "category")


def fraud_features(spark, folder):
    rows = model.features(model.complete_rows(transactions(spark, folder, model.MODEL_INPUTS)))
    names = [*model.NUMERIC_FEATURES, *model.INDEXED_FEATURES]
    vectors = rows.select("transaction_id", vector_to_array("features").alias("values"))
    elements = [F.col("values")[place].alias(name) for place, name in enumerate(names)]
    return vectors.select("transaction_id", *elements)


def train_test_split(spark, folder):
    rows = model.complete_rows(transactions(spark, folder, model.MODEL_INPUTS))
    part = F.when(model.in_training(), "training").otherwise("test")
    return rows.select("transaction_id", part.alias("part"))


def _trained(spark, folder):
    """The training job's model as loaded, and its test part with scores; once per session and folder."""
    key = (shared_folder(spark), spark.sparkContext.applicationId, folder)
    if key not in _models:
        path = fresh_folder(spark, "model")
        trained = jobs.training_job(spark, feed(spark, folder), path)
        rows = model.complete_rows(transactions(spark, folder, model.MODEL_INPUTS))
        fitted = model.load(path)
        _, test = model.stable_split(rows)
        scored = cut_lineage(model.score(fitted, test), "scored")  # read by checks and evaluators
        _models[key] = fitted, scored, trained.area
    return _models[key]


def fraud_model_predict(spark, folder):
    """The test part, and whether the saved weights give each score."""
    fitted, scored, _ = _trained(spark, folder)
    checked = model.checked_scores(fitted, scored)
    return checked.select("transaction_id", "fraud_label", "probability_holds", "prediction_holds")


def fraud_model_auc(spark, folder):
    """The test part by label, and whether the job's area is that of the evaluator on all thresholds."""
    _, scored, area = _trained(spark, folder)
    exact = model.evaluator_area(scored, bins=0)
    counts = scored.agg(
        F.count_if(F.col("fraud_label") == 1).alias("positives"), F.count_if(F.col("fraud_label") != 1).alias("negatives")
    )
    return counts.select("*", (F.abs(area.scalar() - exact) < 1e-6).alias("area_holds"))


# Streams.


def stream(name, spark, folder):
    topics, checkpoint = _new_topics(spark), fresh_folder(spark, "stream")
    source = feed(spark, folder)
    streams.start_insight(
        spark, source, topics, name, checkpoint, available_now=True
    ).awaitTermination()
    return _rounded(read_insight(spark, topics, name, latest=True).drop("run_id"))


def stream_insights(spark, folder):
    """All fraud tables from one stream, put together in long form."""
    topics, checkpoint = _new_topics(spark), fresh_folder(spark, "stream")
    source, names = feed(spark, folder), insights.FRAUD_INSIGHTS
    streams.start_insights(
        spark, source, topics, names, checkpoint, available_now=True
    ).awaitTermination()
    result = None
    for name in names:
        dimension = insights.insight(name).dimension
        rows = read_insight(spark, topics, name, latest=True).select(
            F.lit(dimension).alias("dimension"),
            F.col(dimension).alias("key"),
            *insights.FRAUD_MEASURES,
        )
        result = rows if result is None else result.unionAll(rows)
    return result


def stream_sales(spark, folder):
    """All sales tables from one stream in long form: counts, and the fraud table's percentages."""
    topics, names = _new_topics(spark), insights.SALES_INSIGHTS
    streams.start_insights(
        spark, feed(spark, folder), topics, names, fresh_folder(spark, "stream"), available_now=True
    ).awaitTermination()
    parts = []
    for name in names:
        value = "fraud_percentage" if name == "fraud" else "transaction_count"
        parts.append(read_insight(spark, topics, name, latest=True).select(
            F.lit(name).alias("insight"), F.col(insights.insight(name).dimension).alias("key"),
            F.col(value).cast("double").alias("value"),
        ))
    return reduce(DataFrame.unionAll, parts)


def stream_two_queries(spark, folder):
    """Two queries with checkpoints of their own into one topic; both runs are there."""
    topics, source = _new_topics(spark), feed(spark, folder)
    for _ in range(2):
        streams.start_insight(
            spark, source, topics, "payment_method", fresh_folder(spark, "stream"), available_now=True
        ).awaitTermination()
    every = read_insight(spark, topics, "payment_method")
    return every.groupBy("payment_method").agg(
        F.max("transaction_count").alias("transaction_count"), F.count_distinct("run_id").alias("runs")
    )


def stream_decode(spark, folder):
    path, checkpoint = fresh_folder(spark, "decoded"), fresh_folder(spark, "stream")
    streams.start_decode(
        spark, feed(spark, folder), path, checkpoint, available_now=True
    ).awaitTermination()
    return spark.read.parquet(path)


def stream_quarantine(spark, folder):
    """All messages of the faulty feed by way of a stream: good ones without a reason, and refused ones."""
    path, checkpoint = fresh_folder(spark, "decoded"), fresh_folder(spark, "stream")
    streams.start_decode(
        spark, dirty_feed(spark, folder), path, checkpoint, available_now=True, refused_path=f"{path}-refused"
    ).awaitTermination()
    good = read_batches(spark, path, typed_schema()).withColumn("reason", F.lit(None).cast("string"))
    refused = read_batches(spark, f"{path}-refused", "reason string, value binary")
    _, again = quality.split_quarantine(refused)
    return good.select("transaction_id", *_REFUSED).unionByName(again.select("transaction_id", *_REFUSED))


def stream_detail(spark, folder):
    """Later messages first, then the ones they replace, then those again: a batch each."""
    topics, path = _new_topics(spark), fresh_folder(spark, "detail")
    rows = transactions(spark, folder)
    for sent, day in ((chargebacks(rows), "2024-01-02"), (rows, "2024-01-01"), (rows, "2024-01-01")):
        messages = encode_rows(as_text(sent)).withColumn("timestamp", F.lit(day).cast("timestamp"))
        topics.write(messages, TRANSACTIONS_TOPIC)
        streams.start_detail(spark, topics, path, f"{path}-checkpoint", available_now=True).awaitTermination()
    return _stored_text(spark, path)


QUERIES = {
    "decode_roundtrip": decode_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "typed_transactions": typed_transactions,
    "decode_events_props": decode_events_props,
    "total_rows": total_rows,
    "csv_reordered": csv_reordered,
    "detail_cells": cells,
    "detail_cells_large": cells_large,
    "detail_upsert": detail_upsert,
    "detail_incremental": detail_incremental,
    "detail_quarantine": detail_quarantine,
    "detail_counts": detail_counts,
    "publish_insight": published,
    "insight_latest": insight_latest,
    "insight_latest_empty_run": insight_latest_empty_run,
    "category_analytics": partial(table, "category"),
    "payment_method_distribution": partial(table, "payment_method"),
    "age_distribution": partial(table, "age_group"),
    "city_transaction_count": partial(table, "city"),
    "device_usage": partial(table, "device"),
    "income_spending": partial(table, "income"),
    "fraud_analytics": partial(table, "fraud"),
    **{name: partial(table, name) for name in insights.FRAUD_INSIGHTS},
    "insights_one_pass": insights_one_pass,
    "insights_incremental": insights_incremental,
    "insights_incremental_published": insights_incremental_published,
    "payment_method_share": partial(share, "payment_method"),
    "device_share": partial(share, "device"),
    **{
        f"series_{name}": partial(chart, name)
        for name, wanted in insights.INSIGHTS.items()
        if wanted.series
    },
    "series_empty": series_empty,
    "rule_risk_score": rule_risk_score,
    "risk_calibration": risk_calibration,
    "score_auc": score_auc,
    "dq_amount_mismatch": dq_amount_mismatch,
    "dq_domain_violations": dq_domain_violations,
    "dq_duplicate_ids": dq_duplicate_ids,
    "dq_range_violations": dq_range_violations,
    "quarantine_rows": quarantine_rows,
    "string_index_category": string_index_category,
    "fraud_features": fraud_features,
    "train_test_split": train_test_split,
    "fraud_model_predict": fraud_model_predict,
    "fraud_model_auc": fraud_model_auc,
    "stream_payment_method": partial(stream, "payment_method"),
    "stream_fraud_category": partial(stream, "fraud_category"),
    "stream_category": partial(stream, "category"),
    "stream_insights": stream_insights,
    "stream_sales": stream_sales,
    "stream_two_queries": stream_two_queries,
    "stream_decode": stream_decode,
    "stream_quarantine": stream_quarantine,
    "stream_detail": stream_detail,
}
