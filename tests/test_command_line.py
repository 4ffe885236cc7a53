import json

from tillsight.__main__ import parser, run
from tillsight.operators.insights import insight
from tillsight.operators.latest import read_insight
from tillsight.sinks.csv_files import write_csv
from tillsight.schema import typed_schema
from tillsight.sinks.batches import read_batches
from tillsight.sinks.detail_table import read_detail
from tillsight.sources.warehouse import transactions


def test_from_csv_to_charts(spark, small, tmp_path, capsys):
    """Every command once, each on what the ones before it wrote."""

    def command(*arguments):
        run(spark, parser().parse_args(["--folder", str(tmp_path / "topics"), *arguments]))
        return capsys.readouterr().out

    rows = transactions(spark, small)
    write_csv(rows, str(tmp_path / "csv"))
    command("publish", str(tmp_path / "csv"))
    assert "income_" not in command("sales", "--income") and "device: 3 groups" in command("sales", "--covered", str(tmp_path / "covered"))
    assert read_insight(spark, _topics(tmp_path), "income").count() > 100
    shown = command("fraud", "--rows", "3")
    assert "fraud_percentage" in shown and "more rows" in shown

    arrays = json.loads(command("series", "device"))
    counts = {row[0]: row[1] for row in insight("device").build(rows).collect()}
    assert dict(zip(arrays["labels"], arrays["values"])) == counts

    assert f"{rows.count()} read" in command("detail", str(tmp_path / "detail"))
    stored = read_detail(spark, str(tmp_path / "detail"))
    assert stored.count() == rows.select("transaction_id").distinct().count()
    trained = command("train", str(tmp_path / "model"), "--unseen", "keep", "--random-split", "7")
    assert "area_under_roc" in trained and "left out" in trained

    checkpoint = str(tmp_path / "checkpoint")
    command("publish", str(tmp_path / "csv"))
    command(
        "stream", "device", "category", "--checkpoint", checkpoint, "--available-now",
        "--max-per-trigger", "5",
    )
    command(
        "stream", "records", "--path", str(tmp_path / "records"), "--checkpoint",
        str(tmp_path / "records-checkpoint"), "--available-now",
    )
    assert read_batches(spark, str(tmp_path / "records"), typed_schema()).count() == 2 * rows.count()
    command(
        "stream", "detail", "--path", str(tmp_path / "followed"), "--checkpoint",
        str(tmp_path / "followed-checkpoint"), "--available-now",
    )
    assert read_detail(spark, str(tmp_path / "followed")).count() == stored.count()
    arrays = json.loads(command("series", "device"))
    assert dict(zip(arrays["labels"], arrays["values"])) == {k: 2 * n for k, n in counts.items()}


def _topics(tmp_path):
    from tillsight.sources.topics import FileTopics

    return FileTopics(str(tmp_path / "topics"))
