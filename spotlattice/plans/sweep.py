"""Parameter sweeps: the grid of runs, and a log of what became of each."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import run_tag

LOG = "run_tag string, dataset string, started timestamp, seconds double, status string, message string"


def grid(spark: SparkSession, dataset: list[str], prob: list[float], nms: list[float], growth: list[int], config: list[str]) -> DataFrame:
    """One row per run, with its tag."""
    rows = list(itertools.product(dataset, prob, nms, growth, config))
    df = spark.createDataFrame(rows, "dataset string, prob double, nms double, growth int, config string")
    return df.withColumn("run_tag", run_tag(F.col("prob"), F.col("nms"), F.col("growth"), F.col("config")))


def grid_over(datasets: DataFrame, column: str, prob: list[float], nms: list[float], growth: list[int], config: list[str]) -> DataFrame:
    """The runs of every dataset named in a table; the settings, as many as their lists make, go to every task."""
    settings = grid(datasets.sparkSession, [""], prob, nms, growth, config).drop("dataset")
    return datasets.select(F.col(column).alias("dataset")).crossJoin(F.broadcast(settings)).select("dataset", *settings.columns)


def sweep(runs: DataFrame, run: Callable[[dict], None], log_path: str | None = None) -> DataFrame:
    """Calls ``run`` for every row of the grid; a run that fails is logged and the next one starts. The log is appended after each run."""
    spark, done = runs.sparkSession, []
    for r in (x.asDict() for x in runs.orderBy("dataset", "run_tag").collect()):  # a grid of parameters
        began, status, message = time.time(), "ok", ""
        try:
            run(r)
        except Exception as e:  # the sweep goes on whatever a run raises
            status, message = "failed", str(e)[:500]
        row = [(r["run_tag"], r["dataset"], time.time() - began, status, message)]
        one = spark.createDataFrame(row, "run_tag string, dataset string, seconds double, status string, message string").withColumn("started", F.timestamp_seconds(F.lit(began)))
        one = one.select("run_tag", "dataset", "started", "seconds", "status", "message")
        if log_path:
            one.write.mode("append").parquet(log_path)
        done += one.collect()
    return spark.createDataFrame(done, LOG)
