"""Making the package known to Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SHIPPED = "_spotlattice_shipped"


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once per application, so that workers can import it wherever they run."""
    sc = spark.sparkContext
    if not getattr(sc, _SHIPPED, False):
        own = Path(__file__).resolve().parent
        top = tempfile.mkdtemp(prefix="ship-")
        shutil.copytree(own, os.path.join(top, "src", own.name), ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(os.path.join(top, own.name), "zip", os.path.join(top, "src"), own.name))
        setattr(sc, _SHIPPED, True)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a local folder only where none is set and the master is local. A cluster without one raises."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spotlattice-"))
    return str(sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Eager, reliable checkpoint in the shared folder: survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys over all cores, four tasks a core: a small file is one partition, however long its rows take, and small shuffles are merged."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by keys into as many tasks as the session shuffles into, four a core at least. Left to itself Spark merges small shuffles
    until a task has 64 compressed MB, which sorts and hash tables of narrow rows make more than a GB of."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


class Scratch:
    """Tables of an iteration, as Parquet in the shared folder: unlike checkpoints they carry no facts about
    their columns from round to round (plans of many rounds grow by them), and they can be deleted."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.top = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.held: list[str] = []

    def put(self, df: DataFrame) -> DataFrame:
        folder = f"{self.top}/{len(self.held)}"
        self.held.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def put_seen(self, df: DataFrame, *figures: Column) -> tuple[DataFrame, dict]:
        """``put``, and aggregates of the rows that come from the same job."""
        seen = Observation()
        return self.put(df.observe(seen, *figures)), seen.get

    def drop_before(self, last: int) -> None:
        """Deletes all but the ``last`` tables put in; those that are deleted must not be read any more."""
        jvm = self.spark.sparkContext._jvm
        for folder in self.held[: max(0, len(self.held) - last)]:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
