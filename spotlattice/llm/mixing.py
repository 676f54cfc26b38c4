"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key; within its source documents are ordered by that key and
prefix sums of their sizes say which of them fit the source's budget. The keys are uniform, so
their leading digits are range splitters that need no sampling: the sums run over three levels
(256 ranges, 65,536 ranges, rows of one range), and no task ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last, and is never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``sizes``: one row per source (_sk, source_size). Adds target: the sources share the sum of
    all sizes by weight; no target passes max_epochs times its size, the excess is shared again.

    The repeated sharing has a closed form: with sources in the order of size / weight, a source is
    capped exactly while its cap is below its share of what earlier caps leave.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy("_sk")
    by_ratio = every.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_sk"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    t = (
        sizes.withColumn("_rank", F.row_number().over(by_name))
        .withColumn("_w", F.element_at(cycle, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * F.lit(int(max_epochs)))
        .withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_wleft", F.sum("_w").over(onward))
        .withColumn("_over", F.col("_cap") * F.col("_wleft") <= F.col("_left") * F.col("_w"))
    )
    spent = F.coalesce(F.sum(F.when(F.col("_over"), F.col("_cap"))).over(every), F.lit(0))
    free = F.sum(F.when(~F.col("_over"), F.col("_w"))).over(every)
    share = ((F.col("_total") - spent) * F.col("_w")).cast("double") / free.cast("double")
    return t.withColumn("target", F.when(F.col("_over"), F.col("_cap").cast("double")).otherwise(share)).select("_sk", "source_size", "target")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, and the columns of ``carry``.

    A source whose budget is e times its size plus a rest is taken whole e times; the rest is cut
    from the order of the keys at the exact word, so one document per source may be taken in part
    (its first words). Budgets are targets rounded down to whole words.

    Null or blank text has size 0 and takes nothing; a null source is a source of its own, last in
    order; a null id has a key as any other. Repeated rows count each; which of equal rows is cut
    makes no difference to the result. No rows give no rows. Other columns are not read.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    rows = cut(
        docs.select(
            F.col(id_col).alias("_id"), _source_key(F.col(source_col)).alias("_sk"), word_count(F.col(text_col)).alias("size"), key.alias("_key"),
            *[c.alias(f"_c_{k}") for k, c in (carry or {}).items()],
        )
    ).select("*", F.substring("_key", 1, 2).alias("_b1"), F.substring("_key", 1, 4).alias("_b2"))
    fine = rows.groupBy("_sk", "_b1", "_b2").agg(F.sum("size").alias("_n"))
    coarse = fine.groupBy("_sk", "_b1").agg(F.sum("_n").alias("_n"))
    targets = source_targets(coarse.groupBy("_sk").agg(F.sum("_n").alias("source_size")), weights, max_epochs)

    def ahead(of: list[str], order: list[str], what: str) -> Column:
        w = Window.partitionBy(*of).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(what).over(w), F.lit(0))

    first = coarse.select("_sk", "_b1", ahead(["_sk"], ["_b1"], "_n").alias("_a1")).join(targets, "_sk")
    second = fine.select("_sk", "_b1", "_b2", ahead(["_sk", "_b1"], ["_b2"], "_n").alias("_a2")).join(first, ["_sk", "_b1"]).drop("_b1")
    placed = rows.select("_id", "_sk", "_b2", "size", *[f"_c_{k}" for k in carry or {}], ahead(["_sk", "_b2"], ["_key", "_id", "size"], "size").alias("_a3")).join(second, ["_sk", "_b2"])
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - whole * F.col("source_size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - (F.col("_a1") + F.col("_a2") + F.col("_a3"))))
    return placed.select(F.col("_id").alias(id_col), "size", "source_size", "target", (whole * F.col("size") + last).cast("long").alias("taken"), *[F.col(f"_c_{k}").alias(k) for k in carry or {}])


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, whole.

    A document of which the last epoch takes a part is taken whole there; documents of size 0 stay
    once. Rows that repeat id, source and text share what is taken of them evenly, to whole times.
    All columns stay. Which texts are repeated is settled by a join on (id, source, text hash).
    """
    names = {"i": F.col(id_col), "t": F.col(text_col), "s": F.col(source_col)}
    own = docs.select(*[c.alias(k) for k, c in names.items()])
    taken = mix_sources(own, "i", "t", "s", carry={"s": F.col("s"), "h": F.xxhash64(F.coalesce("t", F.lit("")))}, **options)
    whole = F.ceil(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1)))
    times = taken.groupBy("i", "s", "h").agg(F.when(F.sum("size") == 0, F.lit(1)).otherwise(whole).cast("int").alias("_times")).filter("_times != 1")
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    at = F.col(id_col).eqNullSafe(F.col("i")) & F.col(source_col).eqNullSafe(F.col("s")) & (key == F.col("h"))
    counted = docs.join(times, at, "left").withColumn("_times", F.coalesce("_times", F.lit(1)))
    repeated = F.explode(F.when(F.col("_times") > 0, F.sequence(F.lit(1), F.col("_times"))).otherwise(F.array().cast("array<int>")))
    return counted.withColumn("_epoch", repeated).select(*[docs[f"`{c}`"] for c in docs.columns])
