"""Spot positions, sparse count matrices and bundles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names under which a barcode and a place come.
BARCODES = ("barcode", "barcode_id", "Barcode", "barcodes", "spot_id", "BC")
PLACES = (("x", "y"), ("pxl_col_in_fullres", "pxl_row_in_fullres"), ("pxl_col", "pxl_row"), ("col", "row"))


def coerce_positions(df: DataFrame) -> DataFrame:
    """barcode, x, y from the first known names; raises ValueError where there are none."""
    barcode = next((c for c in BARCODES if c in df.columns), None)
    place = next((p for p in PLACES if all(c in df.columns for c in p)), None)
    if barcode is None:
        raise ValueError(f"no barcode column among {df.columns}")
    if place is None:
        raise ValueError(f"no x and y columns among {df.columns}")
    return df.select(F.col(f"`{barcode}`").cast("string").alias("barcode"), F.col(f"`{place[0]}`").cast("double").alias("x"), F.col(f"`{place[1]}`").cast("double").alias("y"))


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return coerce_positions(spark.read.parquet(path))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one gzip file (one partition) with their place."""
    text = spark.read.text(path)
    return text.withColumn("ix", F.monotonically_increasing_id())


def read_mtx(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts barcode, gene_ix, n; genes gene_ix, gene_id, gene_name; barcodes) of a folder of gzip files matrix.mtx, features.tsv, barcodes.tsv.

    The matrix file has genes in rows and numbers from 1. A features file of one column names genes by their ids.
    """
    cols = F.split("value", "\t")
    genes = _numbered(spark, f"{folder}/features.tsv.gz").select("ix", cols[0].alias("gene_id"), F.coalesce(F.get(cols, F.lit(1)), cols[0]).alias("gene_name"))
    genes = genes.select(F.col("ix").alias("gene_ix"), "gene_id", "gene_name")
    barcodes = _numbered(spark, f"{folder}/barcodes.tsv.gz").select(F.col("ix").alias("bc_ix"), F.trim("value").alias("barcode"))
    lines = _numbered(spark, f"{folder}/matrix.mtx.gz").filter(~F.startswith("value", F.lit("%")) & (F.trim("value") != ""))
    part = F.split(F.trim("value"), r"\s+")
    size = lines.agg(F.min("ix").alias("first"))  # the line of sizes
    body = lines.join(F.broadcast(size), F.col("ix") > F.col("first"))
    coo = body.select((part[0].cast("long") - 1).alias("gene_ix"), (part[1].cast("long") - 1).alias("bc_ix"), part[2].cast("double").alias("n"))
    return coo.join(barcodes, "bc_ix").select("barcode", "gene_ix", "n"), genes, barcodes.select("barcode")


def align(positions: DataFrame, counts: DataFrame, barcodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions that the matrix knows and the counts at known positions; a barcode that comes twice in the matrix raises."""
    if barcodes.groupBy("barcode").count().filter("count > 1").limit(1).count():
        raise ValueError("a barcode comes twice in the matrix")
    known = positions.join(barcodes, "barcode", "left_semi")
    return known, counts.join(known.select("barcode"), "barcode", "left_semi")


def write_bundle(folder: str, x: DataFrame, obs: DataFrame, var: DataFrame, uns: dict) -> None:
    """A matrix with its cells, genes and notes, as a folder of Parquet tables and one JSON text."""
    x.write.mode("overwrite").parquet(f"{folder}/X")
    obs.write.mode("overwrite").parquet(f"{folder}/obs")
    var.write.mode("overwrite").parquet(f"{folder}/var")
    x.sparkSession.createDataFrame([(json.dumps(uns, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/uns")


def read_bundle(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    uns = json.loads(spark.read.text(f"{folder}/uns", wholetext=True).first()["value"])
    return spark.read.parquet(f"{folder}/X"), spark.read.parquet(f"{folder}/obs"), spark.read.parquet(f"{folder}/var"), uns


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
