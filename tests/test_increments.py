"""Loads and insight runs that take only what is new, and reads that stay fixed while a topic grows."""

import json
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillsight import workspace
from tillsight.operators.insights import insight, one_pass
from tillsight.operators.latest import read_insight
from tillsight.operators.partials import finished_insights
from tillsight.plans import jobs
from tillsight.schema import ENVELOPE
from tillsight.sinks import covered_store, ranged_store
from tillsight.sinks.detail_table import read_detail
from tillsight.sinks.publish import publish_insight, publish_transactions
from tillsight.sinks.ranged_store import dealt, manifest, merge_ranges, read_ranges, write_ranges
from tillsight.sinks.versions import complete_versions
from tillsight.sources.topics import FileTopics, KafkaTopics, resolve_offsets
from tillsight.sources.warehouse import chargebacks, transactions


def keyed(spark, numbers, at):
    """Rows of a table with key, a value, and when they arrived."""
    rows = spark.createDataFrame([(f"{n:06d}", str(at), at) for n in numbers], "key string, said string, at bigint")
    return rows.select(F.encode("key", "UTF-8").alias("key"), "said", "at")


def stored(rows, path, expected):
    return write_ranges(dealt(rows, "key", expected), path, "key")


def contents(rows):
    return {bytes(row.key).decode(): row.said for row in rows.collect()}


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(ranged_store, "ROWS_PER_RANGE", 50)


def test_untouched_ranges_are_shared(spark, tmp_path, small_ranges):
    path = str(tmp_path / "table")
    schema = keyed(spark, [1], 1).schema
    assert stored(keyed(spark, range(400), 1), path, 400) == (400, 0)
    first = {entry.folder for entry in manifest(spark, path)}
    assert len(first) >= 6
    merged = merge_ranges(keyed(spark, [*range(30, 34), 999], 2), path, "key", "at", schema)
    assert merged == (401, 400)
    second = {entry.folder for entry in manifest(spark, path)}
    assert len(first - second) == 2 and len(second - first) == 2
    expected = {f"{n:06d}": "2" if 30 <= n < 34 else "1" for n in range(400)} | {"000999": "2"}
    assert contents(read_ranges(spark, path, schema)) == expected
    old, _ = complete_versions(spark, path)
    assert set(contents(read_ranges(spark, path, schema, old)).values()) == {"1"}


def test_a_merge_again_and_an_older_one_change_nothing(spark, tmp_path, small_ranges):
    path, schema = str(tmp_path / "table"), keyed(spark, [1], 1).schema
    stored(keyed(spark, range(0, 200, 2), 5), path, 100)
    for at in (7, 7, 3):
        merge_ranges(keyed(spark, range(0, 200, 10), at), path, "key", "at", schema)
        found = contents(read_ranges(spark, path, schema))
        assert found == {f"{n:06d}": "7" if n % 10 == 0 else "5" for n in range(0, 200, 2)}


def test_a_grown_range_is_cut_and_small_keys_go_first(spark, tmp_path, small_ranges):
    path, schema = str(tmp_path / "table"), keyed(spark, [1], 1).schema
    stored(keyed(spark, range(1000, 1040), 1), path, 40)
    assert len(manifest(spark, path)) == 1
    merge_ranges(keyed(spark, range(0, 180), 2), path, "key", "at", schema)
    entries = manifest(spark, path)
    assert [entry.rows for entry in entries] == [50, 50, 50, 50, 20]
    assert bytes(entries[0].low) == b"000000"
    assert len(contents(read_ranges(spark, path, schema))) == 220


def test_a_merge_of_far_more_rows_makes_new_ranges(spark, tmp_path, monkeypatch):
    """One small range must not take all rows of a large merge into one task."""
    monkeypatch.setattr(ranged_store, "_LEAST_ROWS", 50)
    path, schema = str(tmp_path / "table"), keyed(spark, [1], 1).schema
    stored(keyed(spark, range(0, 400, 20), 5), path, 20)
    assert len(manifest(spark, path)) == 1
    assert merge_ranges(keyed(spark, range(400), 3), path, "key", "at", schema) == (400, 20)
    entries = manifest(spark, path)
    assert len(entries) >= 6 and max(entry.rows for entry in entries) < 200
    expected = {f"{n:06d}": "3" if n % 20 else "5" for n in range(400)}
    assert contents(read_ranges(spark, path, schema)) == expected
    assert merge_ranges(keyed(spark, range(400), 4), path, "key", "at", schema) == (400, 400)
    assert contents(read_ranges(spark, path, schema)) == {key: "5" if said == "5" else "4" for key, said in expected.items()}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Of a job's earlier steps, whether or not the driver has collected its garbage."""
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {file for folder in folders for file in Path(folder).rglob("shuffle_*.data")}
    before = files()
    workspace.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("id")).count(), "counted")
    until = time.time() + 5  # executors remove them in the background
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_empty_tables_and_empty_merges(spark, tmp_path):
    path, schema = str(tmp_path / "table"), keyed(spark, [1], 1).schema
    assert stored(keyed(spark, [1], 1).limit(0), path, 0) == (0, 0)
    assert read_ranges(spark, path, schema).collect() == []
    assert merge_ranges(keyed(spark, [4], 1), path, "key", "at", schema).rows == 1
    assert merge_ranges(keyed(spark, [4], 1).limit(0), path, "key", "at", schema) == (1, 1)
    assert contents(read_ranges(spark, path, schema)) == {"000004": "1"}


def test_a_merge_that_fails_leaves_the_version_before(spark, tmp_path, small_ranges):
    path, schema = str(tmp_path / "table"), keyed(spark, [1], 1).schema
    stored(keyed(spark, range(100), 1), path, 100)
    broken = keyed(spark, [3], 2).withColumn("said", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        merge_ranges(broken, path, "key", "at", schema)
    assert set(contents(read_ranges(spark, path, schema)).values()) == {"1"}


class GrowingTopics(FileTopics):
    """A topic that gets more messages each time it was read or pinned."""

    def _grow(self, spark):
        more = '{"transaction_id":"new-%d"}', "junk"
        rows = spark.range(10).select(F.when(F.col("id") < 7, F.format_string(more[0], "id")).otherwise(more[1]).alias("value"))
        FileTopics(self.root).write(rows, "transactions")

    def read(self, spark, topic):
        messages = super().read(spark, topic)
        self._grow(spark)
        return messages

    def pinned(self, spark, topic, covered=None):
        fixed = super().pinned(spark, topic, covered)
        self._grow(spark)
        return fixed


def test_counts_add_up_while_the_topic_grows(spark, small, tmp_path):
    topics = GrowingTopics(str(tmp_path / "topics"))
    rows = transactions(spark, small)
    publish_transactions(rows, topics)
    publish_transactions(chargebacks(rows), topics)
    sent = FileTopics(topics.root).read(spark, "transactions").count()
    load = jobs.detail_job(spark, topics, str(tmp_path / "table"))
    assert load.rows_read == sent == load.stored + load.replaced + load.refused
    assert load.stored == read_detail(spark, str(tmp_path / "table")).count() and load.refused == 0
    trained = jobs.training_job(spark, topics, str(tmp_path / "model"))
    assert trained.rows_read > sent and trained.left_out < trained.rows_read
    again = jobs.detail_job(spark, topics, str(tmp_path / "table"))
    assert again.refused > 0 and again.rows_read == again.stored + again.replaced + again.refused


def test_a_load_reads_its_topic_once(spark, small, tmp_path, monkeypatch):
    topics = FileTopics(str(tmp_path / "topics"))
    publish_transactions(transactions(spark, small), topics)
    reads = []
    read = FileTopics.read
    monkeypatch.setattr(FileTopics, "read", lambda self, spark, topic: reads.append(self.files) or read(self, spark, topic))
    jobs.detail_job(spark, topics, str(tmp_path / "table"))
    assert [files for files in reads if files] == [topics.pinned(spark, "transactions").files]


def test_refused_messages_that_are_alike_are_all_kept(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    alike = [("junk", 1)] * 3 + [("junk", 2), ('{"transaction_id":"a"}', 1), ('{"transaction_id":"a"}', 2), (None, 1)]
    rows = spark.createDataFrame(alike, "value string, offset bigint")
    when = F.lit("2024-01-01").cast("timestamp")
    topics.write(rows.select("value", "offset", F.lit(0).alias("partition"), when.alias("timestamp")), "transactions")
    load = jobs.detail_job(spark, topics, str(tmp_path / "table"))
    assert (load.rows_read, load.stored, load.refused, load.replaced) == (7, 1, 5, 1)
    from tillsight.sinks.detail_store import read_version

    assert read_version(spark, str(tmp_path / "table-refused")).count() == 5


def test_file_topics_pin_and_cover(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "a folder"))
    assert topics.pinned(spark, "t").files == ()
    topics.write(spark.range(20, numPartitions=2).select(F.col("id").cast("string").alias("value")), "t")
    first = topics.pinned(spark, "t")
    topics.write(spark.range(5, numPartitions=1).select(F.col("id").cast("string").alias("value")), "t")
    assert len(first.files) == 2 and first.read(spark, "t").count() == 20
    second = topics.pinned(spark, "t", first.covers("t"))
    assert second.read(spark, "t").count() == 5
    third = topics.pinned(spark, "t", first.covers("t") | second.covers("t"))
    assert third.read(spark, "t").count() == 0 and third.read(spark, "t").schema == ENVELOPE


def test_streams_of_folders_keep_to_their_times(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    times = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03")]
    rows = spark.createDataFrame(times, "value string, at string")
    topics.write(rows.select("value", F.col("at").cast("timestamp").alias("timestamp")), "t")
    stream = replace(topics, since="2024-01-02", until="2024-01-03").read_stream(spark, "t")
    query = stream.writeStream.format("memory").queryName("between").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [bytes(row.value) for row in spark.table("between").collect()] == [b"b"]


def test_kafka_offsets_are_fixed_and_covered():
    ends = lambda spark, topic: ({0: 5, 1: 0}, {0: 100, 1: 7})
    kafka = KafkaTopics("b:1", ends=ends)
    fixed = kafka.pinned(None, "t")
    assert json.loads(fixed.starting_offsets) == {"t": {"0": 5, "1": 0}}
    assert json.loads(fixed.ending_offsets) == {"t": {"0": 100, "1": 7}} and not kafka.bounded
    assert fixed.covers("t") == {"0": 100, "1": 7}
    later = kafka.pinned(None, "t", {"0": 60, "1": 7})
    assert json.loads(later.starting_offsets) == {"t": {"0": 60, "1": 7}}
    with pytest.raises(ValueError, match="ends before"):
        kafka.pinned(None, "t", {"0": 101})
    marks = '{"t":{"0":-2,"1":-1,"2":9}}'
    assert resolve_offsets(marks, "t", {0: 5, 1: 0, 2: 0}, {0: 100, 1: 7, 2: 10}) == {0: 5, 1: 7, 2: 9}


def parts(spark, small, count):
    rows = transactions(spark, small)
    return [rows.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(count)) == part) for part in range(count)]


def rounded(df):
    return sorted(
        df.select(*[F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]).collect(), key=str
    )


def test_a_run_reads_new_messages_alone(spark, small, tmp_path, monkeypatch):
    topics, path = FileTopics(str(tmp_path / "topics")), str(tmp_path / "covered")
    reads = []
    read = FileTopics.read
    monkeypatch.setattr(FileTopics, "read", lambda self, spark, topic: reads.append((topic, self.files)) or read(self, spark, topic))
    for rows in parts(spark, small, 3):
        publish_transactions(rows, topics)
        tables = jobs.increment_job(spark, topics, topics, path)
    jobs.increment_job(spark, topics, topics, path)
    taken = [set(files) for topic, files in reads if topic == "transactions" and files]
    assert len(taken) == 3 and not (taken[0] & taken[1] or taken[1] & taken[2] or taken[0] & taken[2])
    whole = transactions(spark, small)
    for name in ("category", "fraud_income", "income"):
        expected = rounded(insight(name).build(whole))
        assert rounded(tables[name]) == expected
        assert rounded(read_insight(spark, topics, name, latest=True).drop("run_id")) == expected
    finished = finished_insights(covered_store.read_covered(spark, path).table)
    assert rounded(finished.select(*sorted(finished.columns))) == rounded(one_pass(whole).select(*sorted(finished.columns)))


def test_a_crash_between_table_and_ledger_counts_nothing_twice(spark, small, tmp_path, monkeypatch):
    topics, path = FileTopics(str(tmp_path / "topics")), str(tmp_path / "covered")
    first, second = parts(spark, small, 2)
    publish_transactions(first, topics)
    jobs.increment_job(spark, topics, topics, path, run_id=1)
    publish_transactions(second, topics)
    with monkeypatch.context() as broken:
        broken.setattr(covered_store, "write_ledger", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            jobs.increment_job(spark, topics, topics, path, run_id=2)
    seen = read_insight(spark, topics, "category", latest=True)
    assert {row.run_id for row in seen.collect()} == {1}
    tables = jobs.increment_job(spark, topics, topics, path, run_id=3)
    assert rounded(tables["category"]) == rounded(insight("category").build(transactions(spark, small)))


def test_an_incremental_run_takes_no_bounds(spark, tmp_path):
    with pytest.raises(ValueError, match="no start or end"):
        jobs.increment_job(spark, FileTopics(str(tmp_path), since="2024-01-01"), None, str(tmp_path))


def test_the_latest_run_is_read_without_the_history(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    rows = spark.createDataFrame([("PayPal", 1)], "payment_method string, transaction_count bigint")
    for run in (7, 9, 8):
        publish_insight(rows, topics, "payment_method_analytics", run_id=run)
    latest = read_insight(spark, topics, "payment_method", latest=True)
    assert {name.split("/")[-2] for name in latest.inputFiles()} == {"run-9"}
    assert [row.run_id for row in latest.collect()] == [9]
    (tmp_path / "payment_method_analytics" / "run-9" / "_SUCCESS").unlink()
    assert [row.run_id for row in read_insight(spark, topics, "payment_method", latest=True).collect()] == [8]
    assert read_insight(spark, topics, "payment_method").count() == 3


def test_kafka_runs_leave_a_pointer(spark, monkeypatch):
    """The connector is not here, so its reads and writes are recorded."""
    sent = []
    ends = lambda spark, topic: ({0: 0}, {0: 40 + len(sent)})
    kafka = KafkaTopics("b:1", ends=ends)
    assert replace(kafka, ends=lambda spark, topic: ({0: 3}, {0: 3})).last_run(spark, "t") is None
    pointer = spark.createDataFrame([('{"run_id": 5, "from": {"0": 41}}',)], "value string").select(F.encode("value", "UTF-8").alias("value"))
    monkeypatch.setattr(KafkaTopics, "read", lambda self, spark, topic: sent.append((topic, self.starting_offsets)) or pointer)
    found = kafka.last_run(spark, "t")
    assert json.loads(found.starting_offsets) == {"t": {"0": 41}} and found.ending_offsets == "latest"
    assert sent == [("t-runs", '{"t-runs": {"0": 39}}')]
