import pytest
import pickle
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from tillsight.functions.cells import FAMILIES
from tillsight.operators.detail import detail_cells, detail_rows, last_messages, parsed
from tillsight.plans import jobs
from tillsight.sinks.detail_store import read_version, write_detail_store, write_version
from tillsight.sinks.detail_table import read_detail
from tillsight.sinks.publish import publish_transactions
from tillsight.sources.topics import FileTopics
from tillsight.sources.warehouse import chargebacks, transactions


def recording_writer(folder):
    """A writer whose puts can be read back by the test; tasks run in other processes."""

    def open_writer():
        class Writer:
            def __init__(self):
                self.puts = []
                self.sizes = []

            def put_batch(self, batch):
                batch = list(batch)
                self.sizes.append(len(batch))
                self.puts.extend(batch)

            def close(self):
                path = Path(folder) / uuid.uuid4().hex
                path.write_bytes(pickle.dumps((self.sizes, self.puts)))

        return Writer()

    return open_writer


def recorded(folder):
    return [pickle.loads(path.read_bytes()) for path in Path(folder).iterdir()]


def test_families():
    assert {family: len(names) for family, names in FAMILIES.items()} == {
        "transaction_data": 9,
        "customer_data": 6,
    }


def test_null_is_an_empty_cell(spark, small):
    rows = transactions(spark, small).withColumn("user_city", F.lit(None).cast("string"))
    row = detail_rows(rows).first()
    assert bytes(row.customer_data.user_city) == b""
    assert bytes(row.row_key).count(b"-") == 3
    cells = detail_cells(rows)
    assert cells.count() == rows.count() * 15
    assert cells.filter("qualifier = 'user_city'").select("value").distinct().first()[0] == ""


def test_store_gets_every_row_in_batches(spark, small, tmp_path):
    rows = transactions(spark, small).repartition(3)
    written = write_detail_store(detail_rows(rows), recording_writer(tmp_path), batch_size=500)
    puts = [put for _, task in recorded(tmp_path) for put in task]
    assert written == len(puts) == rows.count()
    assert max(size for sizes, _ in recorded(tmp_path) for size in sizes) <= 500
    key, cells = puts[0]
    assert isinstance(key, bytes) and len(cells) == 15
    assert set(cells) == {f"{f}:{n}".encode() for f, names in FAMILIES.items() for n in names}
    expected = {
        row.transaction_id.encode(): str(row.user_income).encode() for row in rows.collect()
    }
    assert {key: cells[b"customer_data:user_income"] for key, cells in puts} == expected


def test_loading_twice_equals_loading_once(spark, small, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    rows = transactions(spark, small).dropDuplicates(["transaction_id"])
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    publish_transactions(rows, topics)
    jobs.detail_job(spark, topics, str(tmp_path / "once"))
    publish_transactions(rows, topics)
    jobs.detail_job(spark, topics, str(tmp_path / "twice"))
    once, twice = (read_detail(spark, str(tmp_path / name)) for name in ("once", "twice"))
    assert once.count() == rows.count()
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_later_message_wins_and_rows_without_id_are_left_out(spark, small, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    rows = transactions(spark, small)
    publish_transactions(rows, topics)
    publish_transactions(chargebacks(rows), topics)
    publish_transactions(rows.withColumn("transaction_id", F.lit("")), topics)
    written = jobs.detail_job(
        spark, topics, open_writer=recording_writer(_made(tmp_path / "puts"))
    )
    puts = [put for _, task in recorded(tmp_path / "puts") for put in task]
    assert written.stored == rows.select("transaction_id").distinct().count() == len(puts)
    assert written.refused == rows.count()
    assert written.rows_read == written.stored + written.replaced + written.refused
    for _, cells in puts:
        if cells[b"customer_data:fraud_label"] == b"1":
            assert cells[b"transaction_data:total_amount"] == b"0.0"


def test_parquet_load_shuffles_once_and_parses_winners_only(spark, small, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    publish_transactions(transactions(spark, small), topics)
    plan = detail_rows(parsed(last_messages(jobs.arrivals(spark, topics)).filter("reason is null")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange"):]
    assert "user_gender" not in before and "price" not in before


def test_failed_load_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "table")
    write_version(spark.range(3), path)
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_version(broken, path)
    assert read_version(spark, path).count() == 3
    write_version(spark.range(5), path)
    assert read_version(spark, path).count() == 5
    with pytest.raises(ValueError):
        read_version(spark, str(tmp_path / "nothing"))


def test_load_from_a_start_keeps_the_rows_before(spark, tmp_path):
    topics, path = FileTopics(str(tmp_path / "topics")), str(tmp_path / "table")
    sent = [("a", "1", "01"), ("b", "1", "01"), ("a", "2", "02"), ("c", "1", "02"), ("b", "0", "00")]
    rows = spark.createDataFrame(sent, "transaction_id string, quantity string, day string")
    value = F.to_json(F.struct("transaction_id", "quantity")).alias("value")
    messages = rows.select(value, F.concat(F.lit("2024-01-1"), F.substring("day", 2, 1)).cast("timestamp").alias("timestamp"))
    later = FileTopics(topics.root, since="2024-01-12")
    topics.write(messages.filter("timestamp < '2024-01-12'"), "transactions")
    with pytest.raises(ValueError):
        jobs.detail_job(spark, later, path)
    jobs.detail_job(spark, topics, path)
    topics.write(messages.filter("timestamp >= '2024-01-12'"), "transactions")
    again = FileTopics(topics.root, since="2024-01-10", until="2024-01-11")
    for source, counts in ((later, (2, 3, 1)), (again, (1, 3, 1))):
        load = jobs.detail_job(spark, source, path)
        assert (load.rows_read, load.stored, load.replaced) == counts
        stored = read_detail(spark, path)
        assert stored.columns == ["row_key", *FAMILIES]
        found = {bytes(r.row_key): bytes(r.transaction_data.quantity) for r in stored.collect()}
        assert found == {b"a": b"2", b"b": b"1", b"c": b"1"}


def _made(path):
    path.mkdir()
    return path
