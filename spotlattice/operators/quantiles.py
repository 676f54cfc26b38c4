"""Exact quantiles without a buffer that holds all values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quantiles(df: DataFrame, by: str, x: str, probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """One row per ``by``: a column per entry of ``probs``, interpolated between neighbouring ranks as ``percentile`` does.

    A mergeable sketch, whose ranks are off by at most n / accuracy, brackets every quantile; one more
    pass counts what lies below the bracket and ranks the values inside it, some 6 / accuracy of all.
    Groups of up to ``accuracy`` values are ranked whole. ``by`` has few values (metrics): its
    brackets are broadcast. Nulls do not count; a group of nothing else gets nulls.
    """
    width, names = 3.0 / accuracy, list(probs)
    ends = [min(1.0, max(0.0, p + s)) for p in probs.values() for s in (-width, width)]
    v = F.col(x).cast("double")
    d = df.select(F.col(by).alias("_g"), v.alias("_x"))
    sketch = d.groupBy("_g").agg(F.count("_x").alias("_n"), F.percentile_approx("_x", ends, accuracy).alias("_e"))
    few = F.col("_n") <= accuracy
    open_ = lambda at: few | F.lit(ends[at] in (0.0, 1.0))  # noqa: E731  the bracket has no end there
    one = [
        F.struct(
            F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("pos"),
            F.when(~open_(2 * i), F.col("_e")[2 * i]).alias("lo"), F.when(~open_(2 * i + 1), F.col("_e")[2 * i + 1]).alias("hi"),
        )
        for i, (name, p) in enumerate(probs.items())
    ]
    brackets = sketch.select("_g", F.array(*one).alias("_b"))
    at = brackets.withColumnRenamed("_g", "_k")
    each = d.join(F.broadcast(at), d["_g"].eqNullSafe(at["_k"])).select("_g", "_x", F.explode("_b").alias("b")).select("_g", "_x", "b.*")
    # what is below the bracket only counts: all of it is one row without a value; nulls count 0 and keep their group
    inside = F.when(F.col("lo").isNull() | (F.col("_x") >= F.col("lo")), F.col("_x"))
    low_enough = F.col("_x").isNull() | F.col("hi").isNull() | (F.col("_x") <= F.col("hi"))
    counted = each.filter(low_enough).groupBy("_g", "name", "pos", inside.alias("_i")).agg(F.count("_x").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy("_g", "name").orderBy(F.col("_i").asc_nulls_first()))
    low, high = F.floor("pos"), F.ceil("pos")
    holds = lambda k: (F.col("_u") > k) & (F.col("_u") - F.col("_c") <= k)
    found = counted.withColumn("_u", upto).groupBy("_g", "name", "pos").agg(F.max(F.when(holds(low), F.col("_i"))).alias("a"), F.max(F.when(holds(high), F.col("_i"))).alias("b"))
    value = F.when(low == high, F.col("a")).otherwise((high - F.col("pos")) * F.col("a") + (F.col("pos") - low) * F.col("b"))
    return found.groupBy(F.col("_g").alias(by)).agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n in names])
