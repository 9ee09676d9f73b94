"""Communities of a weighted graph by modularity moves (the Louvain method), on edge tables.

The graph is an edge table (``src``, ``dst``, ``w``) read as undirected; a node's community starts
as itself. A round is a few aggregates and joins: the weight from every node to each community
next to it, the total degree of each community, and for every node the move of largest modularity
gain. Moves are made in parallel by half of the nodes a round (by a hash of node and round), so
two neighbours rarely swap at once; a round is kept only if the modularity of the whole graph,
computed afresh, has grown. After two rounds in a row without growth, communities are contracted
into nodes (edge weights added up, those inside a community kept as a loop) and the next level
starts; it ends when a level moves nothing. Only the modularity, one number, reaches the driver
each round; every table is written to the scratch folder, so the plan of a round does not grow.

Nodes with the same neighbours at the same weights (copies) may come as a class: edges are then between classes,
and every two members of a class are linked with weight 1. All members in one community have the same best move,
so a round counts members per (class, community) and never pairs them; it makes the moves it would make
on the edges between all members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.scratch import scratch_dir

# Gains at or below this are not moves, and modularity must grow by more than this.
_EPSILON = 1e-12


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of every edge (``src``, ``dst``, ``w``), weights of equal pairs added;
    a loop once, with twice its weight. Null ends and non-positive weights are left out. Rows of one ``src`` lie together,
    so that a task that adds up by ``src`` sends on its sums only."""
    kept = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("w") > 0))
    both = kept.select("src", "dst", "w").unionByName(kept.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.repartition("src").groupBy("src", "dst").agg(F.sum("w").alias("w"))


def modularity(adj: DataFrame, nodes: DataFrame) -> float:
    """Modularity of the assignment ``nodes`` (``node``, ``comm``) on ``adj`` (both directions)."""
    src = nodes.select(F.col("node").alias("src"), F.col("comm").alias("cs"))
    dst = nodes.select(F.col("node").alias("dst"), F.col("comm").alias("cd"))
    rows = adj.join(src, "src").join(dst, "dst")
    total = rows.agg(F.sum("w")).first()[0] or 0.0
    if total == 0:
        return 0.0
    inside = rows.filter(F.col("cs") == F.col("cd")).agg(F.sum("w")).first()[0] or 0.0
    degrees = rows.groupBy("cs").agg(F.sum("w").alias("tot"))
    squares = degrees.agg(F.sum(F.col("tot") * F.col("tot"))).first()[0] or 0.0
    return inside / total - squares / (total * total)


def _state(nodes: DataFrame, links: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Of an assignment ``nodes`` (``node``, ``cls``, ``comm``): the weight from each class to each community
    next to it (``cls``, ``c``, ``k_in``, ``n`` members there), a member's link with itself counted in;
    the total degree of each community (``c``, ``tot``); and the modularity times the total weight."""
    counts = _stored(nodes.groupBy("cls", F.col("comm").alias("c")).agg(F.count("*").alias("n")))
    outer = links.join(counts.withColumnRenamed("cls", "dst"), "dst").select(
        F.col("src").alias("cls"), "c", (F.col("w") * F.col("n")).alias("k_in"), F.lit(0).cast("long").alias("n")
    )
    inner = counts.join(classes, "cls").select("cls", "c", (F.col("inner") * F.col("n")).alias("k_in"), "n")
    near = _stored(outer.unionByName(inner).groupBy("cls", "c").agg(F.sum("k_in").alias("k_in"), F.sum("n").alias("n")))
    tot = _stored(counts.join(classes, "cls").groupBy("c").agg(F.sum(F.col("n") * F.col("k")).alias("tot")))
    inside = near.filter(F.col("n") > 0).join(classes, "cls").agg(
        F.sum(F.col("n") * (F.col("k_in") - F.col("inner") + F.col("loop")))
    ).first()[0] or 0.0
    sums = tot.agg(F.sum("tot"), F.sum(F.col("tot") * F.col("tot"))).first()
    total = sums[0] or 0.0
    return near, tot, (inside / total - sums[1] / (total * total) if total else 0.0)


def _round(nodes: DataFrame, near: DataFrame, tot: DataFrame, classes: DataFrame, total: float, parity: int, seed: int) -> DataFrame:
    """The assignment after the moving half of the nodes each took its best move."""
    k, to = F.col("k"), near.filter("k_in > 0").join(classes, "cls").join(tot, "c")
    worth = to.select("cls", "c", "k_in", "tot", (F.col("k_in") / total - k * F.col("tot") / (total * total)).alias("worth"))
    # the best community of a class, and the second for members that are in it
    rank = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("worth"), "c"))
    best = worth.withColumn("rank", rank).filter("rank <= 2").drop("worth")
    own = near.filter("n > 0").join(classes, "cls").withColumnRenamed("c", "comm").select(
        "cls", "comm", "k", (F.col("k_in") - F.col("inner")).alias("k_own")
    ).join(tot.select(F.col("c").alias("comm"), F.col("tot").alias("tot_own")), "comm")
    gain = 2 * (F.col("k_in") - F.col("k_own")) / total - 2 * k * (F.col("tot") - F.col("tot_own") + k) / (total * total)
    moves = (
        own.join(best, "cls").filter(F.col("c") != F.col("comm"))
        .groupBy("cls", "comm").agg(F.min_by(F.struct("c", gain.alias("gain")), "rank").alias("m"))
        .select("cls", "comm", F.col("m.c").alias("to"), F.col("m.gain").alias("gain"))
    )
    moving = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(2)) == parity
    return nodes.join(moves, ["cls", "comm"], "left").select(
        "node", "cls", F.when(moving & (F.col("gain") > _EPSILON), F.col("to")).otherwise(F.col("comm")).alias("comm")
    )


def _graph(adj: DataFrame, members: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links between different classes (``src``, ``dst``, ``w``); of each class (``cls``) the weight between
    members (``inner``), of a member's ``loop``, and a member's degree ``k``; and each node (``node``,
    ``cls``, ``comm``: itself). Without ``members`` (``node``, ``cls``) every node is a class."""
    links = adj.filter(F.col("src") != F.col("dst"))
    loops = adj.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("cls"), F.col("w").alias("loop"))
    if members is None:
        members = adj.select(F.col("src").alias("node")).distinct().select("node", F.col("node").alias("cls"))
    sizes = _stored(members.groupBy("cls").agg(F.count("*").alias("m")))
    outer = links.join(sizes.withColumnRenamed("cls", "dst"), "dst").groupBy(F.col("src").alias("cls")).agg(
        F.sum(F.col("w") * F.col("m")).alias("outer")
    )
    inner = F.when(F.col("m") > 1, 1.0).otherwise(0.0)
    loop, to = F.coalesce("loop", F.lit(0.0)), F.coalesce("outer", F.lit(0.0))
    classes = sizes.join(loops, "cls", "left").join(outer, "cls", "left").select(
        "cls", inner.alias("inner"), loop.alias("loop"), (to + inner * (F.col("m") - 1) + loop).alias("k")
    )
    classes = _stored(classes.filter(F.col("k") > 0))
    nodes = members.join(classes.select("cls"), "cls", "left_semi")
    return links, classes, _stored(nodes.select("node", "cls", F.col("node").alias("comm")))


def louvain(
    edges: DataFrame, max_levels: int = 10, max_rounds: int = 50, members: DataFrame | None = None
) -> DataFrame:
    """``node``, ``community`` (the least node of it) for every linked node of ``edges`` (``src``,
    ``dst``, ``w`` > 0, undirected). With ``members`` (``node``, ``cls``), edges are between classes and stand for
    one between any two members; members of one class are linked with weight 1. ``max_levels`` and
    ``max_rounds`` only guard against a run that does not settle; a level ends as soon as two
    rounds in a row gain nothing."""
    links, classes, nodes = _graph(_stored(adjacency(edges)), members)
    membership = nodes.select(F.col("node").alias("original"), "node")
    level = 0
    while level < max_levels:
        total = nodes.join(classes, "cls").agg(F.sum("k")).first()[0] or 0.0
        if total == 0:
            break
        near, tot, best = _state(nodes, links, classes)
        idle, moved, rounds = 0, False, 0
        while idle < 2 and rounds < max_rounds:
            trial = _stored(_round(nodes, near, tot, classes, total, rounds % 2, level * 1000 + rounds))
            *state, score = _state(trial, links, classes)
            if score > best + _EPSILON:
                nodes, (near, tot), best, idle, moved = trial, state, score, 0, True
            else:
                idle += 1
            rounds += 1
        if not moved:
            break
        # contract: communities become nodes; what a member has with itself is its loop only
        at = near.filter("n > 0").select("cls", F.col("c").alias("src"), "n")
        outer = at.join(near.filter("k_in > 0").select("cls", F.col("c").alias("dst"), "k_in"), "cls").select(
            "src", "dst", (F.col("n") * F.col("k_in")).alias("w")
        )
        self_ = at.join(classes, "cls").select("src", F.col("src").alias("dst"), (F.col("n") * (F.col("loop") - F.col("inner"))).alias("w"))
        adj = _stored(outer.unionByName(self_).groupBy("src", "dst").agg(F.sum("w").alias("w")).filter((F.col("src") == F.col("dst")) | (F.col("w") > 0)))
        membership = _stored(
            membership.join(nodes, "node").select("original", F.col("comm").alias("node"))
        )
        links, classes, nodes = _graph(adj)
        level += 1
    final = membership.join(nodes, "node").select(F.col("original").alias("node"), "comm")
    least = final.groupBy("comm").agg(F.min("node").alias("community"))
    return final.join(least, "comm").select("node", "community")
