"""Token-ID output: documents in ascending id order, written to and read from files with
Elias-Fano coded boundaries.

Documents are range-partitioned by id, so a task writes whole files of its own range; the order of
files is (task, number in task). A file's place in the whole is the sum of the ids in files before
it, taken from a manifest of one small row per file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .eliasfano import NULL_ID, TokenFile, encode_file
from .storage import cut, new_dir
from .tokens import encoder, vocabulary_path

MANIFEST = "file string, task int, number int, docs long, n_ids long"


def _put(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Writes beside the place and moves it there: a task that runs again leaves the same file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/_{name}.{attempt}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{path}/{name}")


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    leading_blank: bool = True,
    end_id: int = 0,
    file_ids: int = 8_000_000,
) -> DataFrame:
    """Writes files ``tokens-<task>-<number>.bin`` of about ``file_ids`` ids and returns their manifest.

    Every document is the ids of its text (null: empty) and ``end_id``. Null ids come first; rows
    of one id keep any order by text. A document longer than ``file_ids`` has a file of its own. No
    rows give no files. Other columns are not read. ``folder`` is one that all executors reach; what
    is in it counts only if the manifest names it, so files of lost tasks do no harm.
    """
    spark = ship(docs.sparkSession)
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")

    def run(frames):
        enc = encoder(path, leading_blank)
        context = TaskContext.get()
        task, attempt = context.partitionId(), context.taskAttemptId()
        names: list[tuple] = []
        ids: list[bytes] = []
        keys: list = []
        sizes: list[int] = []
        held = 0

        def close():
            name = f"tokens-{task:06d}-{len(names):05d}.bin"
            _put(folder, name, encode_file(keys, sizes, b"".join(ids), 2), attempt)
            names.append((name, task, len(names), len(keys), sum(sizes)))
            ids.clear(), keys.clear(), sizes.clear()

        end = np.array([end_id], dtype="<u2").tobytes()
        for f in frames:
            for at in range(0, len(f), 256):
                part = f.iloc[at : at + 256]
                for key, missing, got in zip(part["k"], part["missing"], enc.encode(["" if x is None else x for x in part["t"]]), strict=True):
                    ids.append(got.tobytes() + end)
                    keys.append(None if missing else int(key))
                    sizes.append(len(got) + 1)
                    held += sizes[-1]
                    if held >= file_ids:
                        close()
                        held = 0
        if keys:
            close()
        yield pd.DataFrame(names, columns=["file", "task", "number", "docs", "n_ids"])

    k = F.col(id_col).cast("long")
    rows = docs.select(F.coalesce(k, F.lit(NULL_ID)).alias("k"), k.isNull().alias("missing"), F.col(text_col).alias("t"))
    ordered = rows.repartitionByRange("k").sortWithinPartitions("k", F.xxhash64("t"))
    return cut(ordered.mapInPandas(run, MANIFEST))


def read_token_files(manifest: DataFrame, folder: str, step: int = 4096) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files.

    ``start``: ids of all documents before it, in all files. The checksum is that of the ids as
    unsigned 32-bit numbers.
    """
    spark = ship(manifest.sparkSession)

    def run(frames):
        for f in frames:
            for name, data in zip(f["file"], f["content"], strict=True):
                got = TokenFile(data)
                for a in range(0, len(got), step):  # a stretch at a time: no table of all offsets
                    b = min(a + step, len(got))
                    ends = got.ends.part(a, b)
                    begins = np.concatenate(([got.ends.select(a - 1) if a else 0], ends[:-1]))
                    sums = [zlib.crc32(got.ids[i:j].astype("<u4").tobytes()) for i, j in zip(begins, ends, strict=True)]
                    own = pd.array(got.doc_ids(a, b), dtype="Int64")
                    yield pd.DataFrame({"file": name, "doc_id": own, "begin": begins, "n_tokens": ends - begins, "ids_crc32": np.array(sums, dtype=np.int64)})

    def ahead(w):
        return F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tasks = manifest.groupBy("task").agg(F.sum("n_ids").alias("n_ids"))
    firsts = tasks.select("task", ahead(Window.orderBy("task")).alias("first"))  # one row a task
    own = manifest.select("file", "task", ahead(Window.partitionBy("task").orderBy("number")).alias("own"))
    places = own.join(F.broadcast(firsts), "task").select("file", (F.col("first") + F.col("own")).alias("start"))
    files = spark.read.format("binaryFile").load(f"{folder}/tokens-*.bin").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = files.mapInPandas(run, "file string, doc_id long, begin long, n_tokens long, ids_crc32 long")  # what is joined has no contents
    return found.join(places, "file").select("doc_id", (F.col("start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_file_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents to a new folder under the shared one and reads it back."""
    spark = docs.sparkSession
    folder = new_dir(spark, "tokens")
    manifest = write_token_files(docs, folder, id_col, text_col)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(manifest, folder)
