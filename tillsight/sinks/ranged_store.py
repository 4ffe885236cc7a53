"""A keyed table in files of key ranges, of which a load rewrites only those it touches.

A version of the table is a manifest: a row for each range with its first key,
its number of rows and the folder that holds it. A load writes new folders for
the ranges its keys fall into, and a manifest that lists these beside the
folders of all other ranges as they were. Readers go by the last manifest that
is complete, so a load that fails leaves the version before.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_right
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.sinks.detail_store import write_version
from tillsight.sinks.versions import last_version
from tillsight.workspace import COMPRESSION, hadoop_path, shuffles_removed

#: Rows of a range, at most about; one that has grown to twice as many is cut.
ROWS_PER_RANGE = 1_000_000
#: A new table has as many ranges as shuffles have partitions, if they get this many rows.
_LEAST_ROWS = 50_000
#: A merge into many ranges writes them in this many turns at most, as its shuffles and sorts take disk for a turn only.
_TURNS = 4

_MANIFEST = "low binary, rows bigint, folder string"


class Stored(NamedTuple):
    """Rows of the version that was written, and of the one it was merged with."""

    rows: int
    before: int


def dealt(rows: DataFrame, key: str, expected: int) -> DataFrame:
    """``rows``, about ``expected`` of them, in a partition for each range of a new table."""
    return rows.repartitionByRange(_ranges_of(rows.sparkSession, expected), key)


def _ranges_of(spark: SparkSession, expected: int) -> int:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(expected / ROWS_PER_RANGE), min(tasks, math.ceil(expected / _LEAST_ROWS)))


def write_ranges(rows: DataFrame, path: str, key: str) -> Stored:
    """A new version that holds ``rows`` alone, each partition of them a range.

    ``key`` is a binary column without repeats or nulls, by whose order
    ``dealt`` made the partitions.
    """
    placed = rows.withColumns({"range": F.spark_partition_id(), "part": F.lit(0)})
    folder = f"data-{uuid.uuid4().hex}"
    _write(placed, key, f"{path}/{folder}")
    return _commit(rows.sparkSession, path, key, [folder], [])


def _write(placed: DataFrame, key: str, path: str) -> None:
    in_order = placed.sortWithinPartitions("range", "part", key)
    with shuffles_removed(in_order.sparkSession):
        in_order.write.partitionBy("range", "part").parquet(path, compression=COMPRESSION)


def merge_ranges(
    rows: DataFrame, path: str, key: str, arrival: str, schema: T.StructType, finish: Callable[[DataFrame], DataFrame] | None = None
) -> Stored:
    """A new version in which ``rows`` are merged with the last one, the later ``arrival`` per key.

    ``rows`` have each key once. Merging the same rows again changes nothing.
    They are read once for their keys alone and once for each turn of ranges. With ``finish``
    they may lack columns of the table and have others: it gets the rows that
    stay, those of the table with NULL in the others, and completes the new.
    """
    spark = rows.sparkSession
    entries = manifest(spark, path)
    before = sum(entry.rows for entry in entries)
    if not entries:
        return write_ranges(dealt(rows, key, 0), path, key)
    added = rows.withColumn("range", _range_of(spark, [bytes(entry.low) for entry in entries])(key))
    counts = {row.range: row["count"] for row in added.groupBy("range").count().collect()}
    touched, expected = sorted(counts), sum(counts.values()) + before
    if not touched:
        return Stored(before, before)
    if len(touched) == len(entries) and expected >= 2 * _LEAST_ROWS and _ranges_of(spark, expected) >= 2 * len(entries):
        # Much more than the table's few ranges were made for: all is dealt to new ones.
        old = _read_folders(spark, path, [entry.folder for entry in entries], schema)
        both = dealt(old.unionByName(rows, allowMissingColumns=finish is not None), key, expected)
        placed = _newest(both, [key], arrival).withColumns({"range": F.spark_partition_id(), "part": F.lit(0)})
        name = f"data-{uuid.uuid4().hex}"
        _write(finish(placed) if finish else placed, key, f"{path}/{name}")
        return Stored(_commit(spark, path, key, [name], []).rows, before)
    at_once = max(spark.sparkContext.defaultParallelism, math.ceil(len(touched) / _TURNS))
    names = []
    for turn in (touched[first : first + at_once] for first in range(0, len(touched), at_once)):
        places = [(entries[place].folder, place, task) for task, place in enumerate(turn)]
        # At most a row for each range of the table.
        by_folder = F.broadcast(spark.createDataFrame(places, "folder string, range int, task int"))
        old = _read_folders(spark, path, [folder for folder, _, _ in places], schema)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"(data-[0-9a-f]+/range=\d+/part=\d+)/[^/]*$", 1)
        old = old.withColumn("folder", folder).join(by_folder, "folder").select(*schema.names, "range", "task")
        mine = added.join(by_folder.drop("folder"), "range")
        names.append(f"data-{uuid.uuid4().hex}")
        both = old.unionByName(mine, allowMissingColumns=finish is not None)
        _write(_merged(both, key, arrival, schema, len(turn), finish), key, f"{path}/{names[-1]}")
    gone = set(touched)
    kept = [entry for place, entry in enumerate(entries) if place not in gone]
    return Stored(_commit(spark, path, key, names, kept).rows, before)


def _newest(both: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    fields = [name for name in both.columns if name not in (*keys, arrival)]
    newest = both.groupBy(*keys).agg(F.max_by(F.struct(*fields), arrival).alias("newest"), F.max(arrival).alias(arrival))
    return newest.select(*keys, "newest.*", arrival)


def _merged(both: DataFrame, key: str, arrival: str, schema: T.StructType, ranges: int, finish) -> DataFrame:
    """The row of the latest ``arrival`` of each key, with ``range`` and ``part``; ``task`` numbers the ranges."""
    newest = _newest(both.repartitionById(ranges, "task"), ["task", "range", key], arrival)
    # The aggregation has a range's rows in one task in the order of keys, so numbering them moves nothing.
    within = Window.partitionBy("task", "range")
    number, size = F.row_number().over(within.orderBy(key)) - 1, F.count("*").over(within)
    cut = F.when(size >= 2 * ROWS_PER_RANGE, F.floor(number / ROWS_PER_RANGE)).otherwise(0).cast("int")
    placed = newest.withColumn("part", cut).drop("task")
    return finish(placed) if finish else placed.select(*schema.names, "range", "part")


def manifest(spark: SparkSession, path: str, version: str | None = None) -> list:
    """(low, rows, folder) of each range of a version, by first key; the last complete one if none is given.

    The driver holds it: a row for each ``ROWS_PER_RANGE`` rows of the table.
    """
    entries = spark.read.schema(_MANIFEST).parquet(version or last_version(spark, path)).collect()
    return sorted(entries, key=lambda entry: bytes(entry.low))


def read_ranges(spark: SparkSession, path: str, schema: T.StructType, version: str | None = None) -> DataFrame:
    """The table as the last complete version, or the one in folder ``version``, has it."""
    folders = [entry.folder for entry in manifest(spark, path, version)]
    return _read_folders(spark, path, folders, schema)


def _read_folders(spark, path, folders, schema):
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in folders])


def _range_of(spark: SparkSession, lows: list[bytes]):
    """The place of the range that a key falls into; below all, the first. Only keys go to Python."""
    known = spark.sparkContext.broadcast(lows)  # one key per range

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        return pa.array([max(0, bisect_right(known.value, at) - 1) for at in keys.to_pylist()], pa.int32())

    return place


def _commit(spark, path, key, folders, kept) -> Stored:
    """The manifest of the ranges in ``folders`` and those ``kept``, as a new version."""
    entries = []
    for folder in folders:
        if _has_ranges(spark, path, folder):
            ranges = spark.read.parquet(f"{path}/{folder}").groupBy("range", "part")
            added = ranges.agg(F.min(key).alias("low"), F.count("*").alias("rows")).collect()
            entries += [(bytes(row.low), row.rows, f"{folder}/range={row.range}/part={row.part}") for row in added]
    entries += [(bytes(entry.low), entry.rows, entry.folder) for entry in kept]
    write_version(spark.createDataFrame(entries, _MANIFEST).coalesce(1), path)
    return Stored(sum(rows for _, rows, _ in entries), 0)


def _has_ranges(spark, path, folder) -> bool:
    """Whether a load wrote any range; one without rows writes none."""
    place, file_system = hadoop_path(spark, f"{path}/{folder}")
    return any(status.getPath().getName().startswith("range=") for status in file_system.listStatus(place))
