"""Shared scratch folders and landed (written and re-read) DataFrames.

Landed data lives under the folder the session names in ``spark.checkpoint.dir``
so that it outlives any executor. Its retention is the cluster's policy for that
folder. Only a local-mode session without that setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: For scratch on local or mounted disks. Without its native library, Hadoop starts a helper process for each
#: folder, file and checksum file of a task, which may be counted with all memory of its executor until it runs.
#: Without checksum files these are two a task instead of three; other file systems are not touched by this.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

_local_base: str | None = None


def scratch_base(spark: SparkSession) -> str:
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="quotemill-")
    return _local_base


def scratch_path(spark: SparkSession, label: str = "data") -> str:
    """A path nobody else uses; nothing is created there yet."""
    return f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str = "landed", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of the written files.

    The result has no lineage back to ``df``: a lost executor only costs a
    re-read, and values that depend on row placement cannot change any more.
    """
    target = path or scratch_path(df.sparkSession, label)
    df.write.options(**PLAIN_FILES).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
