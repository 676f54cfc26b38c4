"""Cell outlines as GeoJSON, read and written in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matrix import number_rows

FEATURES = "type string, features array<struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
POLYGON, MULTI = "array<array<array<double>>>", "array<array<array<array<double>>>>"


def parse(texts: DataFrame, column: str = "value") -> DataFrame:
    """cell_id, feature, part, ring, xs, ys, props: a row per ring of every Polygon and part of a MultiPolygon.

    ``feature`` is the place in the file, cell_id the property of that name (null if there is
    none). Other geometries, and texts that are no feature collection, give no rows.
    """
    f = texts.select(F.from_json(column, FEATURES).alias("c")).select(F.posexplode("c.features").alias("feature", "f"))
    kind, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(coords, POLYGON))).when(kind == "MultiPolygon", F.from_json(coords, MULTI))
    rings = f.select("feature", "f.properties", F.posexplode(parts).alias("part", "p")).select("feature", "properties", "part", F.posexplode("p").alias("ring", "r"))
    at = lambda i: F.transform("r", lambda p: p[i])
    return rings.select(F.col("properties")["cell_id"].try_cast("long").alias("cell_id"), "feature", "part", "ring", at(0).alias("xs"), at(1).alias("ys"), F.col("properties").alias("props"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return parse(spark.read.text(path, wholetext=True))


def to_features(rings: DataFrame, key: str = "cell_id") -> DataFrame:
    """One JSON feature per cell, closed rings; several parts make a MultiPolygon. A ``props`` column (map) goes on as properties."""
    n = F.size("xs")
    closed = F.when((F.col("xs")[0] == F.col("xs")[n - 1]) & (F.col("ys")[0] == F.col("ys")[n - 1]), F.arrays_zip("xs", "ys")).otherwise(
        F.arrays_zip(F.concat("xs", F.slice("xs", 1, 1)).alias("xs"), F.concat("ys", F.slice("ys", 1, 1)).alias("ys"))
    )
    given = F.col("props") if "props" in rings.columns else F.lit(None).cast("map<string,string>")
    r = rings.select(key, "part", "ring", F.transform(closed, lambda p: F.array(p["xs"], p["ys"])).alias("points"), F.to_json(F.map_filter(given, lambda k, v: k != "cell_id")).alias("props"))
    parts = r.groupBy(key, "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "points"))), lambda x: x["points"]).alias("rings"), F.min("props").alias("props"))
    whole = parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "rings"))), lambda x: x["rings"]).alias("parts"), F.min("props").alias("props"))
    one = F.size("parts") == 1
    geometry = F.concat(F.lit('{"type":"'), F.when(one, F.lit("Polygon")).otherwise(F.lit("MultiPolygon")), F.lit('","coordinates":'), F.when(one, F.to_json(F.col("parts")[0])).otherwise(F.to_json("parts")), F.lit("}"))
    more = F.when(F.length("props") > 2, F.concat(F.lit(","), F.substring("props", 2, 1 << 30))).otherwise(F.lit("}"))
    return whole.select(key, F.concat(F.lit('{"type":"Feature","properties":{"cell_id":'), F.col(key).cast("string"), more, F.lit(',"geometry":'), geometry, F.lit("}")).alias("value"))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """As ``parse``, of one feature a line, so that a file is read in parallel."""
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col(column), F.lit("]}"))
    return parse(lines.select(whole.alias(column)), column)


def pieces(rings: DataFrame) -> DataFrame:
    """``rings`` with every part of a MultiPolygon as a cell of its own: cell_id is the place of (feature, part), from 1."""
    own = rings.drop("cell_id").withColumn("_o", F.col("feature").cast("long") * F.lit(1 << 20) + F.col("part"))
    numbers = number_rows(own.select("_o").distinct(), "_o", "cell_id", 1 << 24)
    return own.join(numbers, "_o").drop("_o").withColumn("part", F.lit(0))


def write_lines(features: DataFrame, path: str) -> None:
    """GeoJSON text sequence: one feature a line, in parallel."""
    features.select("value").write.text(path)
