"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlib.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Edges go from the larger
    to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))
        ).head()
    )


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``c``: the smallest node each node of ``edges`` (``u``, ``v``) can reach; nodes that are the
    smallest themselves are left out.

    Large and small stars alternate until nothing changes, in a number of rounds about the
    logarithm of the longest path. Each round is written to the shared folder. Hot nodes are
    met only by aggregates and joins, which split them.
    """
    edges = stored(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select("u", F.col("v").alias("c"))
