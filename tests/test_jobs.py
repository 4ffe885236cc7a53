from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tillsight.operators.insights import FRAUD_INSIGHTS, SALES_INSIGHTS, insight
from tillsight.operators.latest import read_insight
from tillsight.plans import jobs
from tillsight.sinks.publish import publish_transactions
from tillsight.sources.topics import FileTopics
from tillsight.sources.warehouse import transactions
from tillsight.streaming import insight_streams as streams
from tillsight.workspace import shared_folder


@pytest.fixture
def topics(spark, small, tmp_path):
    result = FileTopics(str(tmp_path / "topics"))
    publish_transactions(transactions(spark, small).repartition(4), result)
    return result


def comparable(df):
    names = [
        F.round(name, 6).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ]
    return sorted(df.select(*names).collect(), key=str)


def test_sales_and_fraud_jobs(spark, small, topics, capsys):
    rows = transactions(spark, small)
    jobs.sales_job(spark, topics, topics, run_id=1)
    tables = jobs.sales_job(spark, topics, topics, run_id=2)
    fraud = jobs.fraud_job(spark, topics, topics)
    assert set(tables) == set(SALES_INSIGHTS) and set(fraud) == set(FRAUD_INSIGHTS)
    for name in (*SALES_INSIGHTS, *FRAUD_INSIGHTS):
        latest = read_insight(spark, topics, name, latest=True).drop("run_id")
        assert comparable(latest) == comparable(insight(name).build(rows))
    both = read_insight(spark, topics, "category")
    assert both.count() == 2 * tables["category"].count()
    jobs.show({"fraud_payment": fraud["fraud_payment"]})
    assert "fraud_percentage" in capsys.readouterr().out


def test_stream_equals_batch_and_resumes(spark, small, topics, tmp_path):
    rows, checkpoint = transactions(spark, small), str(tmp_path / "checkpoint")

    def run():
        query = streams.start_insight(
            spark, topics, topics, "fraud_category", checkpoint, max_per_trigger=1, available_now=True
        )
        query.awaitTermination()
        return query

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    first = run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    spark.conf.set("spark.sql.shuffle.partitions", before)
    states = first.lastProgress.stateOperators
    assert [state.numShufflePartitions for state in states] == [streams.STATE_PARTITIONS]
    assert len({progress.batchId for progress in first.recentProgress}) >= 4  # rate limit
    latest = read_insight(spark, topics, "fraud_category", latest=True).drop("run_id")
    assert comparable(latest) == comparable(insight("fraud_category").build(rows))

    publish_transactions(rows, topics)
    run()
    latest = read_insight(spark, topics, "fraud_category", latest=True).drop("run_id")
    assert comparable(latest) == comparable(insight("fraud_category").build(rows.unionAll(rows)))


def test_one_stream_for_several_insights(spark, small, topics, tmp_path):
    names = ["category", "fraud_income", "city"]
    query = streams.start_insights(
        spark, topics, topics, names, str(tmp_path / "checkpoint"), max_per_trigger=1,
        available_now=True,
    )
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    for name in names:
        latest = read_insight(spark, topics, name, latest=True).drop("run_id")
        assert comparable(latest) == comparable(insight(name).build(transactions(spark, small)))


def test_stream_of_records(spark, small, topics, tmp_path):
    path = str(tmp_path / "records")
    streams.start_decode(
        spark, topics, path, str(tmp_path / "checkpoint"), max_per_trigger=2, available_now=True
    ).awaitTermination()
    rows, found = transactions(spark, small), spark.read.parquet(path)
    assert found.exceptAll(rows).isEmpty() and rows.exceptAll(found).isEmpty()


def test_console_stream(spark, topics):
    query = streams.start_console(streams.transaction_stream(spark, topics, ["category"]))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


class Session:
    """A session without the setting for the shared folder."""

    def __init__(self, master):
        self.conf = SimpleNamespace(get=lambda name, default: default)
        self.sparkContext = SimpleNamespace(master=master, applicationId=master)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))


def test_local_session_gets_one_temporary_folder(monkeypatch, tmp_path):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session)
    assert shared_folder(session).startswith(str(tmp_path))


def test_shared_folder_is_that_of_the_cluster(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
