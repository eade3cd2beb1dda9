"""Folders that the driver and all executors share, and files in them."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

_MARKED: set[tuple[str, str]] = set()


def scratch(spark: SparkSession) -> str:
    """A fresh place below ``spark.checkpoint.dir``; where that is unset, below the warehouse of a session whose
    driver is its only machine.  All of an application's places are deleted when it ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    application = spark.sparkContext.applicationId
    top = f"{root.rstrip('/')}/scratch-{application}"
    if (application, top) not in _MARKED:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MARKED.add((application, top))
    return f"{top}/{uuid.uuid4().hex}"


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a place, and its path there; for use in tasks."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pyarrow.fs.FileSystem.from_uri(uri)


def remove(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Documents of one task.
PART_DOCUMENTS = 1000


def dealt(rows: DataFrame, size: int = PART_DOCUMENTS) -> DataFrame:
    """Rows in partitions of about ``size``, for work that takes long beside the bytes of a row.

    Files, and shuffles under adaptive execution, are cut by bytes, so a million short rows may be one task.
    """
    return rows.repartition(max(1, -(-rows.count() // size)))
