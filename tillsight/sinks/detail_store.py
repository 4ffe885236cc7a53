"""Writing the detail table: Parquet by default, or any keyed store."""

from __future__ import annotations

from collections.abc import Callable
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.cells import FAMILIES
from tillsight.sinks.versions import last_version, next_version
from tillsight.workspace import COMPRESSION, shuffles_removed


def write_version(rows: DataFrame, path: str) -> None:
    """A new version of the table at ``path``, beside those it has.

    Readers see it once it is complete; a job that fails leaves the version
    before. Old versions stay until someone removes their folders.
    """
    with shuffles_removed(rows.sparkSession):
        rows.write.parquet(next_version(rows.sparkSession, path), compression=COMPRESSION)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of the table at ``path``."""
    return spark.read.parquet(last_version(spark, path))


def write_detail_store(
    rows: DataFrame, open_writer: Callable[[], object], batch_size: int = 1000
) -> int:
    """Rows of the wide form into a keyed store; returns how many were put.

    Each task calls ``open_writer()`` once and then ``put_batch(puts)`` with up
    to ``batch_size`` pairs of row key and ``{b"family:qualifier": bytes}``, and
    ``close()``. A task that is retried puts the same cells under the same keys.
    Cells are encoded by Spark and reach the task in Arrow batches.
    """
    columns = [
        (f"{family}:{name}".encode(), F.col(f"{family}.{name}").alias(f"{family}:{name}"))
        for family, names in FAMILIES.items()
        for name in names
    ]
    names = [name for name, _ in columns]

    def put_partition(batches):
        writer = open_writer()
        try:
            for batch in batches:
                keys, *cells = (column.to_pylist() for column in batch.columns)
                puts = zip(keys, (dict(zip(names, row)) for row in zip(*cells)))
                for chunk in batched(puts, batch_size):
                    writer.put_batch(chunk)
                yield pa.record_batch({"rows": [batch.num_rows]})
        finally:
            writer.close()

    flat = rows.select("row_key", *[column for _, column in columns])
    written = flat.mapInArrow(put_partition, "rows bigint").agg(F.sum("rows")).first()[0]
    return written or 0
