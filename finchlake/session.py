"""Session helpers: the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: there, and only there, a temporary folder is used.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="finchlake-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which :func:`drop_written` deletes with all that is put there."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written(df: DataFrame, name: str, partition_by: str | None = None, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that survives lost executors.

    ``partition_by`` keeps the rows of each of its values in files of their own, so that a filter on it
    reads those only. The tables stay until :func:`drop_written` removes them.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> int:
    """Delete what this process put in the shared folder; results that read it end with it."""
    dropped = 0
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        dropped += bool(store.delete(path, True))
    return dropped
