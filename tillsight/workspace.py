"""Where jobs keep tables between steps: the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Of topics and tables: messages repeat their field names, which Spark's default packs half as well.
COMPRESSION = "zstd"

_SETTING = "spark.checkpoint.dir"
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a cluster session without the
    setting is an error. Only a local session gets a temporary folder.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tillsight-")
    return _local_folders[context.applicationId]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, label: str):
    """``df`` written out in full and read back.

    A small result that several later jobs need is computed once, describes
    one snapshot of its source, and survives the loss of any executor.
    """
    return stored(df, label)[0]


def stored(df, label: str):
    """The same, and the path, for a table that is removed once the next one is written."""
    path = fresh_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes in here remove their shuffle files as they end.

    Otherwise the files stay on the executors' disks until the driver happens
    to collect its garbage, those of a job's earlier steps beside the later.
    Each write has a plan of its own, so none of them is read again.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table that ``stored`` wrote and that nothing reads any more."""
    folder, file_system = hadoop_path(spark, path)
    file_system.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself reaches it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
