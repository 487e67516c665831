"""Where jobs put tables that cut a lineage or are read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, reachable from every executor.

    Only a local session may go without it; it then gets one temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark)


_LOCAL_FOLDERS: dict[str, str] = {}


def _local_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="navloom-")
    return _LOCAL_FOLDERS[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a folder that no other run uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of :func:`new_folder`, wherever Spark keeps it; absent is fine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
