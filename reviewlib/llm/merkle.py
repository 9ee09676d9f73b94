"""A Merkle manifest of a table: digests of rows, of groups of rows, of the whole, and proofs.

Every row is a leaf: ``H`` (lowercase hex SHA-256) of its fields, each written ``-`` if null, else
as its UTF-8 byte count, ``:`` and its value (integers in decimal). Leaves of a group ascend by
their order columns; while a group has more than one node, every ``ARITY`` consecutive nodes (the
last run fewer, even one) become the ``H`` of their digests, concatenated as hex text. What
remains is the group's subroot (a lone leaf is its own subroot). Subroots, ordered by group (a
null group first, then by UTF-8 bytes), make the root the same way.

The tree is built by time-forward processing: nodes carry their label (group, level, index), and
each level is one exchange that delivers every child's digest to the parent labelled by index //
ARITY, where the children are put in order and hashed. Each level is written to the shared folder,
so a lost executor costs at most that level. A reversed sweep then delivers, from the root down,
the proof suffix of every node (for each level from it up to the root, the digests of its run's
other members, left and right) to its children, and so to the leaves. A proof is an array of
(left, right) pairs, bottom up; folding a leaf through it gives the root.

No group is gathered: positions within a group come from a range exchange and counts per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.llm.common import stored

ARITY = 3
T_STEP = "struct<left:string,right:string>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """``H`` of the fields written by :func:`field`, one after another."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def group_key(group: Column) -> Column:
    """A non-null text that orders as a null group first, then groups by their UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))


def positions(df: DataFrame, group: str, order: Sequence[Column | str]) -> DataFrame:
    """``df`` with ``idx`` (from 0, by ``order`` within ``group``, a non-null column) and ``size``
    (rows of the group). Rows go to ranges of (group, order) in one exchange; a group spread over
    many ranges takes offsets from a table of counts per (group, range)."""
    parts = max(1, df.rdd.getNumPartitions())
    ranged = stored(
        df.repartitionByRange(parts, group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    counts = counts.select(
        group, "_range", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("size"),
    )
    return ranged.join(counts, [group, "_range"]).select(
        *(c for c in df.columns if c != "size"),
        (F.col("_offset") + F.col("_at") - F.col("_first")).alias("idx"),
        F.col("size").cast("long").alias("size"),
    )


def build(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``nodes`` (``g`` non-null group, ``idx`` from 0, ``digest``, ``size`` nodes of the
    group). Gives the edges of each level (``g``, ``idx``, ``left``, ``right``: the other
    digests of a node's run, before and after it) and the root of each group (``g``, ``digest``)."""
    level = stored(nodes.select("g", "idx", "digest", "size"))
    edges, roots = [], []
    while True:
        roots.append(level.filter(F.col("size") == 1).select("g", "digest"))
        if level.filter(F.col("size") > 1).limit(1).count() == 0:
            break
        runs = (
            level.filter(F.col("size") > 1)
            .groupBy("g", F.floor(F.col("idx") / arity).alias("parent"), "size")
            .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("kids"))
            .withColumn("digests", F.transform("kids", lambda k: k["digest"]))
        )
        runs = stored(runs)
        kids = runs.select("g", "parent", "digests", F.posexplode("kids").alias("at", "kid"))
        edges.append(
            stored(
                kids.select(
                    "g",
                    F.col("kid.idx").alias("idx"),
                    F.array_join(F.slice("digests", 1, F.col("at")), "").alias("left"),
                    F.array_join(F.slice("digests", F.col("at") + 2, arity), "").alias("right"),
                    "parent",
                )
            )
        )
        level = stored(
            runs.select(
                "g",
                F.col("parent").alias("idx"),
                F.sha2(F.array_join("digests", ""), 256).alias("digest"),
                F.ceil(F.col("size") / arity).cast("long").alias("size"),
            )
        )
    root = roots[0]
    for more in roots[1:]:
        root = root.unionByName(more)
    return edges, root


def proofs(edges: list[DataFrame]) -> DataFrame:
    """``g``, ``idx``, ``proof`` of every node at the lowest level that has edges: the
    (left, right) pairs of its runs from there up to its group's root, bottom up. The sweep
    goes from the top level down, one join a level."""
    suffix = None
    for level in reversed(edges):
        own = F.array(F.struct(F.col("left"), F.col("right")))
        if suffix is None:
            suffix = stored(level.select("g", "idx", own.alias("proof")))
            continue
        up = suffix.select("g", F.col("idx").alias("parent"), F.col("proof").alias("up"))
        suffix = level.join(up, ["g", "parent"], "left").select(
            "g", "idx", F.concat(own, F.coalesce("up", F.array().cast(f"array<{T_STEP}>"))).alias("proof")
        )
        if level is not edges[0]:
            suffix = stored(suffix)
    return suffix


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` gives, hashed with each (left, right) of ``proof`` in turn."""
    return F.aggregate(proof, start, lambda acc, e: F.sha2(F.concat(e["left"], acc, e["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """``H`` of all the proof's digests, bottom up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda e: F.array(e["left"], e["right"]))), ""), 256)


def manifest(
    rows: DataFrame,
    group: str,
    order: Sequence[str],
    fields: Sequence[str],
    carry: Sequence[str] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """Every row of ``rows``, its columns ``carry`` (default: all), with ``leaf``, ``subroot``
    (its group's), ``root`` and ``proof`` (an array of (left, right) digests from the leaf to the
    root). Leaves hash ``fields`` in order; within a group they ascend by ``order`` (nulls first),
    ties by leaf digest, so equal rows are interchangeable. Carried columns named ``leaf``,
    ``subroot``, ``root``, ``proof``, ``g``, ``idx`` or ``size`` are replaced. No rows give no rows,
    and a null root."""
    taken = {"leaf", "subroot", "root", "proof", "g", "idx", "size"}
    keep = [c for c in (rows.columns if carry is None else carry) if c not in taken]
    base = rows.select(
        *keep, leaf(*(F.col(f) for f in fields)).alias("leaf"), group_key(F.col(group)).alias("g")
    )
    placed = positions(base, "g", [*(F.col(o).asc_nulls_first() for o in order), F.col("leaf")])
    trees, subroots = build(placed.select("g", "idx", F.col("leaf").alias("digest"), "size"), arity)
    low = proofs(trees) if trees else None
    # Subroots, one per group, ordered by group, make the root.
    tops = positions(subroots.withColumn("t", F.lit("")), "t", [F.col("g")])
    top_edges, top_root = build(tops.select(F.col("t").alias("g"), "idx", "digest", "size"), arity)
    top = (
        tops.select("g", "idx").join(proofs(top_edges).withColumnRenamed("g", "t"), "idx", "left")
        if top_edges
        else tops.select("g", F.lit(None).cast(f"array<{T_STEP}>").alias("proof"))
    ).select("g", F.col("proof").alias("top"))
    empty = F.array().cast(f"array<{T_STEP}>")
    joined = placed.join(subroots.withColumnRenamed("digest", "subroot"), "g").join(top, "g", "left")
    if low is not None:
        joined = joined.join(low.withColumnRenamed("proof", "low"), ["g", "idx"], "left")
    else:
        joined = joined.withColumn("low", F.lit(None).cast(f"array<{T_STEP}>"))
    found = top_root.collect()  # one row, or none for no rows
    root = F.lit(found[0]["digest"] if found else None).cast("string")
    return joined.select(
        *keep, "leaf", "subroot", root.alias("root"),
        F.concat(F.coalesce("low", empty), F.coalesce("top", empty)).alias("proof"),
    )
