import pytest
from pyspark.sql import functions as F

from tillsight.operators.insights import fraud_by
from tillsight.operators.latest import ARRIVAL, arrival_order, latest_by_key, read_insight
from tillsight.schema import COLUMNS, ENVELOPE
from tillsight.sinks.csv_files import write_csv
from tillsight.sinks.publish import first_run_id, publish_insight, publish_insight_batch
from tillsight.sources.csv_files import read_csv
from tillsight.sources.topics import FileTopics, KafkaTopics


def table(spark, rows):
    return spark.createDataFrame(rows, "payment_method string, transaction_count bigint")


def test_kafka_options():
    kafka = KafkaTopics("broker:9092")
    batch = kafka.batch_options("transactions")
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in batch and batch["maxRecordsPerPartition"] == "1000000"
    stream = kafka.stream_options("transactions", 10000)
    assert stream["maxOffsetsPerTrigger"] == "10000" and "endingOffsets" not in stream
    assert kafka.write_options("t") == {"kafka.bootstrap.servers": "broker:9092", "topic": "t"}


def test_kafka_offsets_and_other_options():
    ends = {"starting_offsets": '{"t":{"0":23}}', "ending_offsets": '{"t":{"0":99}}'}
    kafka = KafkaTopics("b:1", **ends, options={"failOnDataLoss": "false", "kafka.security.protocol": "SSL"})
    batch, stream = kafka.batch_options("t"), kafka.stream_options("t")
    assert (batch["startingOffsets"], batch["endingOffsets"]) == tuple(ends.values())
    assert stream["startingOffsets"] == ends["starting_offsets"] and "endingOffsets" not in stream
    for options in (batch, stream, kafka.write_options("t")):
        assert options["kafka.security.protocol"] == "SSL" and options["failOnDataLoss"] == "false"


def test_file_topic_has_kafka_columns(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    messages = spark.range(100, numPartitions=4).select(F.col("id").cast("string").alias("value"))
    topics.write(messages, "t")
    topics.write(messages, "t")
    rows = topics.read(spark, "t")
    assert rows.schema == ENVELOPE
    assert rows.count() == 200
    assert rows.select(*ARRIVAL).distinct().count() == 200


def test_replayed_batch_replaces_itself(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    rows = table(spark, [("PayPal", 1)])
    publish_insight_batch(rows, topics, "payment_method_analytics", 0)
    publish_insight_batch(rows, topics, "payment_method_analytics", 0)
    publish_insight_batch(rows, topics, "payment_method_analytics", 1)
    assert read_insight(spark, topics, "payment_method").count() == 2


def test_latest_run_only(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    topic = "payment_method_analytics"
    publish_insight(table(spark, [("PayPal", 1), ("Gone", 5)]), topics, topic, run_id=9)
    publish_insight(table(spark, [("PayPal", 2), (None, 3)]), topics, topic, run_id=10)
    publish_insight(table(spark, [("PayPal", 2)]), topics, topic, run_id=10)  # a retried task
    every = read_insight(spark, topics, "payment_method")
    assert {tuple(row) for row in every.collect()} == {("PayPal", 1, 9), ("Gone", 5, 9), ("PayPal", 2, 10), (None, 3, 10)}
    assert every.count() == 4
    latest = read_insight(spark, topics, "payment_method", latest=True)
    assert {tuple(row) for row in latest.collect()} == {("PayPal", 2, 10), (None, 3, 10)}


def test_run_cut_short_is_passed_over(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    topic = "payment_method_analytics"
    publish_insight(table(spark, [("PayPal", 1)]), topics, topic, run_id=1)
    cut = [('{"payment_method":"PayPal","transaction_count":7,"run_id":2}',), ('{"run_id":2,"run_rows":2}',)]
    topics.write(spark.createDataFrame(cut[:1], "value string"), topic)
    latest = lambda: [tuple(r) for r in read_insight(spark, topics, "payment_method", latest=True).collect()]
    assert latest() == [("PayPal", 1, 1)]
    topics.write(spark.createDataFrame(cut[1:], "value string"), topic)
    assert latest() == [("PayPal", 1, 1)]
    publish_insight(table(spark, []), topics, topic, run_id=3)
    assert latest() == []


def test_streams_on_new_checkpoints_come_after_the_old(spark, tmp_path):
    first = first_run_id(spark, str(tmp_path / "one"))
    assert first_run_id(spark, str(tmp_path / "one")) == first
    assert first_run_id(spark, str(tmp_path / "two")) > first


def test_folder_topic_between_two_times(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    times = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03")]
    rows = spark.createDataFrame(times, "value string, at string")
    topics.write(rows.select("value", F.col("at").cast("timestamp").alias("timestamp")), "t")
    later = FileTopics(str(tmp_path), since="2024-01-02", until="2024-01-03").read(spark, "t")
    assert [bytes(row.value) for row in later.collect()] == [b"b"]


def test_latest_run_reads_the_topic_once(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    publish_insight(table(spark, [("PayPal", 1)]), topics, "payment_method_analytics", run_id=1)
    latest = read_insight(spark, topics, "payment_method", latest=True)
    latest.collect()
    final = latest._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_latest_without_run_ids_is_the_last_message_per_group(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    for count in (1, 2):
        publish_insight(table(spark, [("PayPal", count)]), topics, "payment_method_analytics")
    latest = read_insight(spark, topics, "payment_method", latest=True)
    assert [tuple(row) for row in latest.collect()] == [("PayPal", 2, None)]


def test_latest_by_key_with_one_very_hot_key(spark):
    """A third of the rows share a key; tasks reduce it before the shuffle."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("value"),
        F.struct((F.col("id") * 7919 % 30000).alias("at")).alias("arrival"),
    )
    latest = latest_by_key(rows, "key")
    expected = max((i * 7919 % 30000, i) for i in range(0, 30000, 3))[1]
    assert latest.filter("key = 'hot'").collect()[0].value == expected
    assert latest.count() == 20001
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_csv_keeps_quotes_commas_and_breaks(spark, tmp_path):
    awkward = ['say "hi"', "a,b", "two\nlines", "", None, "é"]
    rows = spark.createDataFrame([(str(i), text) for i, text in enumerate(awkward)],
                                 "transaction_id string, category string")
    full = rows.select(*[
        (F.col(name) if name in rows.columns else F.lit("x")).alias(name) for name in COLUMNS
    ])
    path = str(tmp_path / "csv")
    write_csv(full, path)
    found = {row.transaction_id: row.category for row in read_csv(spark, path, multi_line=True).collect()}
    assert [found[str(i)] or None for i in range(len(awkward))] == [text or None for text in awkward]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "reordered.csv"
    path.write_text("user_city,other,transaction_id\nRome,x,1-1\n,y,1-2\n")
    rows = read_csv(spark, str(path))
    assert rows.columns == list(COLUMNS)
    found = {row.transaction_id: (row.user_city, row.category) for row in rows.collect()}
    assert found == {"1-1": ("Rome", None), "1-2": (None, None)}
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(path))


def test_arrival_is_a_total_order(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    topics.write(spark.range(10).select(F.col("id").cast("string").alias("value")), "t")
    assert topics.read(spark, "t").select(arrival_order()).distinct().count() == 10


def test_null_group_comes_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, "1", 1)], "category string, transaction_id string, fraud_label int"
    )
    topics = FileTopics(str(tmp_path))
    publish_insight(fraud_by(rows, "category"), topics, "fraud_category")
    assert read_insight(spark, topics, "fraud_category").first().category is None
