"""Exact dedup by content sort, in DataFrame operations only.

Rows are dealt by sampled range splitters over (head of the text, hash, salt) and sorted on disk
where needed; equal texts lie side by side and are compared in full, neighbour by neighbour, by
the window over the whole text. A text that holds more rows than a partition has on average is hot:
its rows are dealt by the hash of the id as well, and its figures come from an aggregation over the
whole text, which adds up in every task before anything is shuffled. There are fewer hot texts than
partitions, so their figures (no texts) are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "largest",
    salts: int = 64,
    carry: list[str] | None = None,
    text_out: str | None = None,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, the columns in ``carry``, and the normalised text as ``text_out``.

    Texts are equal when ``normalise`` (none by default) leaves equal bytes; null counts as empty,
    and all empty texts are one group. ``keep`` says whether the row with the largest or smallest
    id stays. Of rows that share that id and text exactly one stays; null ids lose to all others
    (keep_id is null where a group has no other). No rows give no rows. Columns of the input are
    read only if named, so clashing names do no harm.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    pick = F.max if keep == "largest" else F.min
    best_first = F.col("_id").desc_nulls_last() if keep == "largest" else F.col("_id").asc_nulls_last()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"), (normalise(text) if normalise else text).alias("_text"), *[F.col(c).alias(f"_c_{c}") for c in carry or []]
    ).withColumn("_sha", F.sha2("_text", 256))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = cut(rows.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    hot = counted.filter(F.col("_n") * partitions > docs.count()).select("_sha")  # fewer than partitions
    whole = rows.select("_id", "_text", "_sha").join(F.broadcast(hot), "_sha").groupBy("_text")
    figures = cut(whole.agg(F.min("_sha").alias("_sha"), F.count(F.lit(1)).alias("_hn"), pick("_id").alias("_hk")).drop("_text"))
    salt = F.when(F.col("_hn").isNotNull(), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int")).otherwise(F.lit(-1))
    dealt = (
        rows.join(F.broadcast(figures), "_sha", "left")
        .withColumn("_salt", salt)
        .withColumn("_head", F.substring("_text", 1, 24))
        .withColumn("_hash", F.xxhash64("_text"))
        .repartitionByRange("_head", "_hash", "_salt")
    )
    group = Window.partitionBy("_head", "_hash", "_salt", "_text")
    found = dealt.select(
        "_id", "_sha", "_hn", "_hk", *(["_text"] if text_out else []), *[f"_c_{c}" for c in carry or []],
        F.row_number().over(group.orderBy(best_first)).alias("_rn"), pick("_id").over(group).alias("_keep"), F.count(F.lit(1)).over(group).alias("_n"),
    )
    is_hot = F.col("_hn").isNotNull()
    found = found.withColumns(
        {
            "_rn": F.when(is_hot & ~F.col("_keep").eqNullSafe(F.col("_hk")), F.lit(2)).otherwise(F.col("_rn")),  # ids that are equal share a salt
            "_keep": F.when(is_hot, F.col("_hk")).otherwise(F.col("_keep")),
            "_n": F.coalesce("_hn", "_n"),
        }
    )
    return found.select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"), (F.col("_rn") == 1).alias("kept"),
        F.col("_sha").alias("text_sha256"), *[F.col(f"_c_{c}").alias(c) for c in carry or []],
        *([F.col("_text").alias(text_out)] if text_out else []),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    rest = [docs[f"`{c}`"] for c in docs.columns if c != text_col]
    text = F.col(text_col)
    own = text if options.get("normalise") else F.lit(None).cast("string")  # else the text that was dealt is the text itself
    boxed = docs.select(F.col(id_col).alias("k"), text.alias("t"), F.struct(*rest).alias("row"), own.alias("own"), text.isNull().alias("none"))
    kept = exact_groups(boxed, "k", "t", keep=keep, carry=["row", "own", "none"], text_out="dealt", **options).filter("kept")
    back = F.when(~F.col("none"), F.col("own") if options.get("normalise") else F.col("dealt"))
    return kept.select(*[(back.alias(c) if c == text_col else F.col(f"row.`{c}`")) for c in docs.columns])
