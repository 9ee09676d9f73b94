"""The densest part of a graph by peeling in rounds, for spam rings of authors and messages.

Density is edges per node. Each round removes, at once, every node whose degree among the nodes
still left is at most ``2 * (1 + eps)`` times the density of what is left; the densest of the
sets passed through is within a factor ``2 * (1 + eps)`` of the densest subgraph, and there are
``O(log(nodes) / eps)`` rounds. A round is one aggregate of degrees over the edges still inside
and one anti-join; only two counts reach the driver. Each node gets the round it was removed in,
and the answer is the nodes removed after the best round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlib.scratch import scratch_dir


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def peel(edges: DataFrame, eps: float = 0.1) -> tuple[DataFrame, float]:
    """``node``, ``round`` (when it was peeled), ``dense`` (in the densest set found) for every
    node of ``edges`` (``src``, ``dst``; undirected, repeated edges and loops dropped), and that
    set's density."""
    pairs = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    inside = _stored(pairs.select(low.alias("src"), high.alias("dst")).distinct())
    left = _stored(inside.select(F.col("src").alias("node")).union(inside.select("dst")).distinct())
    removed = []
    best, best_round, rnd = -1.0, 0, 0
    while True:
        n_nodes = left.count()
        if n_nodes == 0:
            break
        n_edges = inside.count()
        density = n_edges / n_nodes
        if density > best:
            best, best_round = density, rnd
        ends = inside.select(F.col("src").alias("node")).unionAll(inside.select(F.col("dst").alias("node")))
        degree = ends.groupBy("node").agg(F.count("*").alias("d"))
        keep = left.join(degree, "node", "left").filter(F.coalesce("d", F.lit(0)) > 2 * (1 + eps) * density)
        keep = _stored(keep.select("node"))
        removed.append(left.join(keep, "node", "left_anti").withColumn("round", F.lit(rnd)))
        kept_src = keep.select(F.col("node").alias("src"))
        kept_dst = keep.select(F.col("node").alias("dst"))
        inside = _stored(inside.join(kept_src, "src", "left_semi").join(kept_dst, "dst", "left_semi"))
        left = keep
        rnd += 1
    if not removed:
        empty = edges.sparkSession.createDataFrame([], "node string, round int, dense boolean")
        return empty, 0.0
    out = removed[0]
    for more in removed[1:]:
        out = out.unionByName(more)
    return out.select("node", F.col("round").cast("int"), (F.col("round") >= best_round).alias("dense")), best
