"""Where operators cut lineage: the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import cut, shared_dir

__all__ = ["cut", "new_dir", "shared_dir"]


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``new_dir`` named, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
