"""A corpus run: five stages, each applying one operator to all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlattice.llm import exact_dedup, mixing, near_dedup, packing, queries, storage, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold. The classifier learns from the labels beside the documents."""
    model = toxicity.learn(docs, queries.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = toxicity.score(docs.select(*COLUMNS), model, column="_score")
    return scored.filter(~toxicity.rejected(model, column="_score")).select(*COLUMNS)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_exact_copies(docs.select(*COLUMNS), keep="smallest")


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id."""
    return near_dedup.drop_near_copies(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents are repeated and left out as the mix says.

    The document at the edge of a source's budget is taken whole if the mix takes any word of it,
    so that texts stay as they are. Documents without a word stay once.
    """
    return mixing.apply_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: one row per piece of a document."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("near_dedup", drop_near), ("mix", mix), ("pack", pack)]

#: A trained classifier, sampled hashes and token ids are not SQL; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = storage.new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
