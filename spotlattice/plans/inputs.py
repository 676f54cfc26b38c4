"""What a run finds before it starts: input files, their checks, the tag of a region, and what the machine offers."""

from __future__ import annotations

import importlib.util
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least bytes of a file by what it is.
LEAST_BYTES = {"image": 1024, "table": 128, "outlines": 64}
#: Optional packages by what they would add.
OPTIONAL = {"h5py": "10x HDF5 files", "anndata": "h5ad files", "scrublet": "another doublet score", "tqdm": "progress bars"}


def discover(spark: SparkSession, folder: str, patterns: list[str]) -> DataFrame:
    """path, pattern, place: files under ``folder`` whose name fits a pattern (as a file glob), earlier patterns first, then by path."""
    found = None
    for i, p in enumerate(patterns):
        files = spark.read.format("binaryFile").option("pathGlobFilter", p).option("recursiveFileLookup", True).load(folder)
        own = files.select("path", F.lit(p).alias("pattern"), F.lit(i).alias("place"), "length")
        found = own if found is None else found.unionByName(own)
    return found.orderBy("place", "path")


def check_files(files: DataFrame, kind: str) -> DataFrame:
    """path, ok, message of each file (path, length): whether it has the least bytes of its kind."""
    least = LEAST_BYTES[kind]
    ok = F.col("length") >= least
    return files.select("path", ok.alias("ok"), F.when(~ok, F.concat(F.lit(f"{kind} under {least} bytes: "), F.col("length").cast("string"))).alias("message"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or ValueError where it has no row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def roi_tag(paths: list[str]) -> str:
    """Tag of a set of region files: what stands between ``.tif.`` and ``.roi``, else their names' common start, else the shortest name."""
    names = [os.path.basename(p) for p in paths]
    if not names:
        raise ValueError("no region files")
    tags = {m[1] for n in names if (m := re.search(r"\.tiff?\.(.+)\.roi$", n, re.I))}
    if len(tags) == 1:
        return tags.pop()
    stems = sorted((re.sub(r"\.roi$", "", n, flags=re.I) for n in names), key=lambda x: (len(x), x))
    start = re.sub(r"\W+$", "", os.path.commonprefix(stems))
    return start if len(start) >= 3 else stems[0]


def available() -> dict[str, str]:
    """'available' or why not, by optional package; nothing is imported."""
    return {p: "available" if importlib.util.find_spec(p) else f"unavailable: {what} are not read" for p, what in OPTIONAL.items()}
