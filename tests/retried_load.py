"""Run by test_retries.py in a session of its own, whose tasks may fail and be retried."""

import pickle
import sys
import uuid
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillsight.operators.detail import detail_rows  # noqa: E402
from tillsight.sinks.detail_store import write_detail_store  # noqa: E402
from tillsight.sources.warehouse import transactions  # noqa: E402


def failing_once(folder):
    """A store that fails one task after it has put a batch."""

    def open_writer():
        class Writer:
            def put_batch(self, batch):
                (Path(folder) / uuid.uuid4().hex).write_bytes(pickle.dumps(list(batch)))
                marker = Path(folder).parent / "failed"
                if not marker.exists():
                    marker.touch()
                    raise ConnectionError("store went away")

            def close(self):
                pass

        return Writer()

    return open_writer


def main(data, folder):
    spark = (
        SparkSession.builder.master("local[2,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .getOrCreate()
    )
    rows = transactions(spark, data).withColumn(
        "transaction_id", F.concat_ws("#", "transaction_id", F.monotonically_increasing_id())
    )
    written = write_detail_store(detail_rows(rows.repartition(4)), failing_once(folder), 100)
    print(written, rows.count())
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
