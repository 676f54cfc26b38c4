"""Stages of a run: typed settings, checks of inputs, results kept by the settings that made them."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class QcSettings:
    mad_mult: float = 3.0
    min_genes: int = 200
    min_umis: int = 500
    max_mito: float = 30.0
    max_top5: float | None = None
    species: str = "mouse"


@dataclass(frozen=True)
class ClusterSettings:
    n_pcs: int = 50
    neighbours: int = 20
    variable_genes: int = 3000
    min_counts: int | None = None
    resolution: float = 1.0
    seed: int = 0


@dataclass
class Stage:
    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    settings: object = None
    needs: list[str] = field(default_factory=list)
    #: Files or folders that the stage reads itself; their sizes and times are part of what a result is kept by.
    inputs: list[str] = field(default_factory=list)
    #: To be raised when the code of the stage changes what it gives.
    version: int = 1


def require(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """``df``, or ValueError where a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} has no {', '.join(missing)}")
    return df


def _marks(spark: SparkSession, paths: list[str]) -> list:
    """(path, bytes, time) of the files under each path, in order."""
    jvm, out = spark.sparkContext._jvm, []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def _key(stage: Stage, keys: dict[str, str], marks: list) -> str:
    settings = dataclasses.asdict(stage.settings) if stage.settings is not None else {}
    return hashlib.sha256(json.dumps([stage.name, stage.version, settings, [keys[n] for n in stage.needs], marks], sort_keys=True).encode()).hexdigest()[:16]


def plan(stages: list[Stage], spark: SparkSession | None = None) -> list[tuple[str, str]]:
    """(stage, folder name) in order, without running anything; raises where a stage needs one that is not before it.

    With a session the files in ``inputs`` count as well, so a changed input names a new folder.
    """
    keys: dict[str, str] = {}
    for s in stages:
        for n in s.needs:
            if n not in keys:
                raise ValueError(f"{s.name} needs {n}, which is not before it")
        keys[s.name] = f"{s.name}-{_key(s, keys, _marks(spark, s.inputs) if spark else [])}"
    return list(keys.items())


def run(spark: SparkSession, stages: list[Stage], folder: str, force: bool = False) -> dict[str, DataFrame]:
    """Results by stage, each written once: a stage whose settings, version and inputs are as before is read instead of run."""
    out: dict[str, DataFrame] = {}
    jvm = spark.sparkContext._jvm
    for s, (name, place) in zip(stages, plan(stages, spark), strict=True):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{place}/_SUCCESS")
        if force or not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            s.run(spark, {n: out[n] for n in s.needs}).write.mode("overwrite").parquet(f"{folder}/{place}")
        out[name] = spark.read.parquet(f"{folder}/{place}")
    return out
