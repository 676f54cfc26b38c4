"""Leiden clusters of a weighted graph, as joins and sums over the edge table.

Every step is a DataFrame: nodes with their degree and cluster, edges with their weight. What a
serial version does node by node happens in batches: moves of a batch all go down one order of the
clusters, drawn by a hash, and the next batch turns the order round. So no two nodes swap places,
and no moves of a batch form a cycle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .neighbours import modularity


def _below(to: Column, from_: Column, batch: int, seed: int) -> Column:
    """Whether moves between these clusters are down the batch's order; batches 2i and 2i + 1 have opposite orders."""
    x, y = F.xxhash64(to, F.lit(seed + batch // 2)), F.xxhash64(from_, F.lit(seed + batch // 2))
    return x < y if batch % 2 else x > y


def _around(edges: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """a, label, w: weight of the edges from each node into each cluster around it, and a row of weight 0 for its own."""
    there = edges.filter("a != b").join(nodes.select(F.col("a").alias("b"), label), "b").select("a", label, "weight")
    own = nodes.select("a", label, F.lit(0.0).alias("weight"))
    return there.unionByName(own).groupBy("a", label).agg(F.sum("weight").alias("w"))


def _gain(w: Column, k: Column, total: Column, own: Column, resolution: float, m2: float) -> Column:
    """What a node adds to modularity in a cluster (times m2 / 2): the cluster's degree is taken without the node."""
    return F.round(w - F.lit(resolution / m2) * k * (total - F.when(own, k).otherwise(F.lit(0.0))), 9)


def _best(scored: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Each node with the label of its best cluster, if that beats its own; ties to the smaller label."""
    own = F.col(label) == F.col("from")
    stay = F.max(F.when(own, F.col("score"))).alias("stay")
    go = F.max(F.when(~own, F.struct("score", (-F.col(label)).alias("label")))).alias("go")
    better = F.coalesce(F.col("go.score") > F.col("stay"), F.lit(False))
    return scored.groupBy("a", "from", *keys).agg(stay, go).select("a", *keys, F.when(better, -F.col("go.label")).otherwise(F.col("from")).alias(label), better.alias("moved"))


def local_moves(edges: DataFrame, nodes: DataFrame, m2: float, resolution: float, batches: int, seed: int, kept: Scratch) -> tuple[DataFrame, int]:
    """``nodes``: a, k, c. Moves nodes to the cluster around them that gains most, batch by batch; ends early when two in a row, of opposite orders, move less than one node in 200 each."""
    moves = still = 0
    for batch in range(batches):
        totals = nodes.groupBy("c").agg(F.sum("k").alias("total"))
        links = _around(edges, nodes, "c").join(nodes.select("a", "k", F.col("c").alias("from")), "a")
        links = links.filter((F.col("c") == F.col("from")) | _below(F.col("c"), F.col("from"), batch, seed))
        score = _gain(F.col("w"), F.col("k"), F.col("total"), F.col("c") == F.col("from"), resolution, m2)
        best = _best(links.join(totals, "c").withColumn("score", score), ["k"], "c")
        moved, seen = kept.put_seen(best, F.count_if("moved").alias("moved"), F.count(F.lit(1)).alias("all"))
        nodes = moved.drop("moved")
        moves += seen["moved"]
        still = still + 1 if 200 * seen["moved"] < seen["all"] else 0
        if still == 2:
            break
    return nodes, moves


def refined(edges: DataFrame, nodes: DataFrame, m2: float, resolution: float, batches: int, seed: int, kept: Scratch) -> DataFrame:
    """``nodes`` with r: parts of each cluster, each connected. From single nodes, those that are well
    connected to their cluster join a part of it; a node that is no longer alone stays where it is."""
    clusters = nodes.groupBy("c").agg(F.sum("k").alias("whole"))
    inside = _around(edges, nodes, "c").join(nodes.select("a", "k", "c"), ["a", "c"]).join(clusters, "c")
    tied = F.col("w") >= F.lit(resolution / m2) * F.col("k") * (F.col("whole") - F.col("k")) - 1e-9
    now = kept.put(inside.select("a", "k", "c", tied.alias("tied"), F.col("a").alias("r")))
    still = 0
    for batch in range(batches):
        parts = now.groupBy("r").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("size"), F.min("c").alias("part_of"))
        links = _around(edges, now, "r").join(now.select("a", "k", "c", "tied", F.col("r").alias("from")), "a").join(parts, "r")
        own = F.col("r") == F.col("from")
        alone = F.max(F.when(own, F.col("size"))).over(Window.partitionBy("a")) == 1
        may = F.col("tied") & (F.col("part_of") == F.col("c")) & _below(F.col("r"), F.col("from"), batch, seed) & (F.col("w") > 0)
        scored = links.withColumn("alone", alone).filter(own | (may & F.col("alone")))
        best = _best(scored.withColumn("score", _gain(F.col("w"), F.col("k"), F.col("total"), own, resolution, m2)), ["k", "c", "tied"], "r")
        told, seen = kept.put_seen(best, F.count_if("moved").alias("moved"), F.count(F.lit(1)).alias("all"))
        now = told.drop("moved")
        still = still + 1 if 200 * seen["moved"] < seen["all"] else 0
        if still == 2:
            break
    return now.drop("tied")


def leiden(edges: DataFrame, resolution: float = 1.0, iterations: int = 2, levels: int = 6, batches: int = 6, refinements: int = 4, seed: int = 0) -> DataFrame:
    """a, cluster: clusters of high modularity, numbered from 0 by size (ties: smallest node).

    ``edges``: a, b (long), weight above 0, each edge in both directions, loops once; repeats add
    up. A level moves nodes (local_moves), splits what is not well connected (refined) and makes one
    node of each part, with the clusters found as the start of the next level; levels end when
    nothing moves and nothing is contracted. An iteration starts again on the whole graph from the clusters found;
    the best of all by modularity is returned (Traag et al., 2019). The number of jobs is bounded by iterations * levels *
    (batches + refinements + 4). No edges give no rows.
    """
    kept = Scratch(edges.sparkSession, "leiden")
    whole = kept.put(edges.filter("weight > 0").groupBy("a", "b").agg(F.sum("weight").alias("weight")))
    degree = kept.put(whole.groupBy("a").agg(F.sum("weight").alias("k")))
    m2 = degree.agg(F.sum("k")).first()[0]
    if not m2:
        return degree.select("a", F.col("a").cast("int").alias("cluster"))
    labels = degree.select("a", F.col("a").alias("c"))
    best, best_q = None, float("-inf")
    for it in range(iterations):
        graph, nodes = whole, degree.join(labels, "a")
        place = degree.select("a", F.col("a").alias("node"))
        moves = 0
        for level in range(levels):
            salt = seed + 1000 * it + 100 * level
            nodes, n = local_moves(graph, nodes, m2, resolution, batches, salt, kept)
            moves += n
            parts = refined(graph, nodes, m2, resolution, refinements, salt + 50, kept)
            size, small = parts.agg(F.count(F.lit(1)), F.count_distinct("r")).first()
            if small == size:
                break
            to = parts.select("a", "r")
            graph = graph.join(to, "a").select(F.col("r").alias("x"), "b", "weight").join(to.withColumnRenamed("a", "b").withColumnRenamed("r", "y"), "b")
            graph = kept.put(graph.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("weight").alias("weight")))
            place = kept.put(place.join(to.withColumnRenamed("a", "node"), "node").select("a", F.col("r").alias("node")))
            nodes = kept.put(parts.groupBy("r").agg(F.sum("k").alias("k"), F.min("c").alias("c")).select(F.col("r").alias("a"), "k", "c"))
        labels = kept.put(place.join(nodes.select(F.col("a").alias("node"), "c"), "node").select("a", "c"))
        q = modularity(whole, labels.withColumnRenamed("c", "cluster"), resolution).first()[0]
        if q > best_q + 1e-12:
            best, best_q = labels, q
        if not moves:
            break
    sizes = best.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("low"))
    # one row a cluster
    numbered = sizes.select("c", (F.row_number().over(Window.orderBy(F.desc("n"), "low")) - 1).cast("int").alias("cluster"))
    out = kept.put(best.join(numbered, "c").select("a", "cluster"))
    kept.drop_before(1)
    return out
