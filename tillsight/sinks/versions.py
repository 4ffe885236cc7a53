"""Numbered versions of a table, of which readers see those that are complete."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillsight.workspace import hadoop_path

_VERSION = "version-"


def next_version(spark: SparkSession, path: str) -> str:
    """The folder of a version after all that were begun under ``path``, complete or not."""
    numbers = [int(name.removeprefix(_VERSION)) for name in _names(spark, path)]
    return f"{path}/{_VERSION}{max(numbers, default=0) + 1:09d}"


def complete_versions(spark: SparkSession, path: str, mark: str = "_SUCCESS") -> list[str]:
    """Folders of the versions that hold the file ``mark``, which is written last; oldest first."""
    folders = [f"{path}/{name}" for name in sorted(_names(spark, path))]
    return [folder for folder in folders if _exists(spark, f"{folder}/{mark}")]


def last_version(spark: SparkSession, path: str, mark: str = "_SUCCESS") -> str:
    complete = complete_versions(spark, path, mark)
    if not complete:
        raise ValueError(f"no complete version under {path}")
    return complete[-1]


def write_mark(spark: SparkSession, path: str) -> None:
    """An empty file that says the folder around it is complete."""
    file, file_system = hadoop_path(spark, path)
    file_system.create(file, False).close()


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, file_system = hadoop_path(spark, path)
    if not file_system.exists(folder):
        return []
    names = (status.getPath().getName() for status in file_system.listStatus(folder))
    return [name for name in names if name.startswith(_VERSION)]


def _exists(spark: SparkSession, path: str) -> bool:
    file, file_system = hadoop_path(spark, path)
    return file_system.exists(file)
