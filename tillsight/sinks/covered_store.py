"""A derived table together with the messages it covers.

A version holds the table and a ledger of the parts of the topic (partitions up
to an offset, or files) that it adds to those before. The ledger is written
last and its success mark completes the version, so the table and what it
covers are always seen together.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.sinks.versions import complete_versions, next_version

_LEDGER = "part string, position bigint"


@dataclass(frozen=True)
class CoveredTable:
    table: DataFrame
    #: How far the topic is covered: the place after the last message of each part.
    positions: Mapping[str, int]

    def is_behind(self, positions: Mapping[str, int]) -> bool:
        """Whether ``positions`` go further."""
        return any(part not in self.positions or at > self.positions[part] for part, at in positions.items())


def read_covered(spark: SparkSession, path: str) -> CoveredTable | None:
    """The last complete version, None without any.

    What is covered is the union of all versions' ledgers: the driver holds a
    row per part of the topic, as Spark does when it lists the topic's files.
    """
    versions = complete_versions(spark, path, "ledger/_SUCCESS")
    if not versions:
        return None
    ledgers = spark.read.schema(_LEDGER).parquet(*[f"{version}/ledger" for version in versions])
    rows = ledgers.groupBy("part").agg(F.max("position").alias("position")).collect()
    return CoveredTable(spark.read.parquet(f"{versions[-1]}/table"), {row.part: row.position for row in rows})


def write_covered(table: DataFrame, path: str, positions: Mapping[str, int]) -> CoveredTable:
    """A new version: ``table``, which covers ``positions`` besides what the versions before do."""
    spark = table.sparkSession
    version = next_version(spark, path)
    table.write.parquet(f"{version}/table")
    write_ledger(spark, version, positions)
    return read_covered(spark, path)


def write_ledger(spark: SparkSession, version: str, positions: Mapping[str, int]) -> None:
    spark.createDataFrame(list(positions.items()), _LEDGER).coalesce(1).write.parquet(f"{version}/ledger")
