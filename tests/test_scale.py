"""What keeps jobs small: short generated code, packed files, nothing kept twice."""

import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.detail import detail_rows, parsed
from tillsight.plans import catalog, jobs
from tillsight.sinks.batches import read_batches
from tillsight.sources.topics import FileTopics
from tillsight.streaming.insight_streams import start_decode
from tillsight.workspace import hadoop_path, shared_folder

#: Longer methods are interpreted by the JVM.
COMPILED_BYTES = 8000


@pytest.fixture
def topics(spark, tmp_path):
    made = FileTopics(str(tmp_path / "topics"))
    values = [('{"transaction_id":"a","price":"12345678.5"}',), ('{"transaction_id":"b"}',), ("junk",)]
    made.write(spark.createDataFrame(values, "value string"), "transactions")
    return made


def test_messages_are_packed(spark, topics):
    assert all(name.endswith(".zstd.parquet") for name in topics.pinned(spark, "transactions").files)


def test_code_for_cells_is_compiled(spark, topics):
    messages = topics.read(spark, "transactions").withColumn("arrival", F.lit(1))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = detail_rows(parsed(messages), ["arrival"])._jdf.queryExecution().explainString(mode)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < COMPILED_BYTES


def test_a_load_leaves_no_table_of_its_own(spark, topics, tmp_path):
    def kept():
        folder, file_system = hadoop_path(spark, shared_folder(spark))
        names = [status.getPath().getName() for status in file_system.listStatus(folder)]
        return {name for name in names if name.startswith(("last-messages", "added"))}

    before = kept()
    for source in (topics, FileTopics(topics.root, since="2000-01-01")):
        load = jobs.detail_job(spark, source, str(tmp_path / "detail"))
        assert (load.stored, load.refused) == (2, 1)
    assert kept() == before


def test_a_batch_is_parted_without_being_kept(spark, topics, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("kept")

    monkeypatch.setattr(type(spark.range(1)), "persist", refuse)
    path, refused = str(tmp_path / "good"), str(tmp_path / "bad")
    start_decode(spark, topics, path, str(tmp_path / "c"), available_now=True, refused_path=refused).awaitTermination()
    assert read_batches(spark, path, "transaction_id string").count() == 2
    assert [row.reason for row in read_batches(spark, refused, "reason string").collect()] == ["unreadable"]


def test_scores_are_computed_once(spark, small):
    _, scored, _ = catalog._trained(spark, small)
    assert isinstance(scored, DataFrame) and "Join" not in scored._jdf.queryExecution().executedPlan().toString()
