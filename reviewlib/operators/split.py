"""Stratified train / validation / test split with exact quotas."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.functions.patterns import LABELS

# The first hex digits of a row's hash put it in one of 16^4 slots.
_SLOT_DIGITS = 4


def encode_label(label: Column | str, labels: Sequence[str] = LABELS) -> Column:
    """Label to id, null for an unknown label."""
    c = F.col(label) if isinstance(label, str) else label
    return (F.nullif(F.array_position(F.lit(list(labels)), c), F.lit(0)) - 1).cast("int")


def decode_label(label_id: Column | str, labels: Sequence[str] = LABELS) -> Column:
    """Id to label, null for an unknown id."""
    c = F.col(label_id) if isinstance(label_id, str) else label_id
    return F.get(F.lit(list(labels)), c.cast("int"))


def shuffle_key(id: str, seed: int = 42) -> Column:
    """A seeded pseudo-random order of rows that does not depend on how they are partitioned."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id).cast("string")))


def shuffle_rows(df: DataFrame, id: str = "review_id", seed: int = 42) -> DataFrame:
    """``df`` in the order of its seeded hash."""
    return df.orderBy(shuffle_key(id, seed))


def _apportion(df: DataFrame, weight: str, draws: str, label: str, out: str) -> DataFrame:
    """Share ``draws`` out over the classes in proportion to ``weight``: whole parts first,
    the rest to the largest remainders, ties in label order. A row per class."""
    classes = Window.partitionBy(draws)
    share = F.col(weight) / F.sum(weight).over(classes) * F.col(draws)
    df = df.withColumn("_share", share).withColumn("_base", F.floor("_share"))
    left = F.col(draws) - F.sum("_base").over(classes)
    nth = F.row_number().over(classes.orderBy(F.desc(F.col("_share") - F.col("_base")), label))
    return df.withColumn(out, F.col("_base") + (nth <= left).cast("long")).drop("_share", "_base")


def split_quotas(
    counts: DataFrame, label: str = "label", n: str = "n", val: float = 0.15, test: float = 0.15
) -> DataFrame:
    """``n_train``, ``n_val`` and ``n_test`` of each class from a (``label``, ``n``) table.

    Held-out rows are ``ceil((val + test) * total)``, test rows the rounded-up rest of
    those; classes share each side in proportion. A class too small to be split, or a
    side smaller than the number of classes, is an error.
    """
    held, part = val + test, 1 - val / (val + test)
    every = Window.partitionBy(F.lit(0))
    sized = (
        counts.select(label, F.col(n).cast("long").alias("n"))
        .withColumn("_total", F.sum("n").over(every))
        .withColumn("_classes", F.count("*").over(every))
        .withColumn("_held", F.ceil(F.lit(held) * F.col("_total")))
        .withColumn("_train", F.col("_total") - F.col("_held"))
        .withColumn("_val", F.col("_held") - F.ceil(F.lit(part) * F.col("_held")))
    )
    out = _apportion(sized, "n", "_train", label, "n_train")
    out = out.withColumn("_rest", F.col("n") - F.col("n_train"))
    out = _apportion(out, "_rest", "_val", label, "n_val")
    out = out.withColumn("n_test", F.col("_rest") - F.col("n_val"))
    problem = F.when(
        F.col("n") < 2, F.concat(F.lit("class with fewer than 2 rows: "), F.col(label))
    ).when(
        F.least("_train", "_val", F.col("_held") - F.col("_val")) < F.col("_classes"),
        F.lit("a side of the split is smaller than the number of classes"),
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("long")).otherwise(
        F.col("n_train")
    )
    return out.select(label, "n", checked.alias("n_train"), "n_val", "n_test")


def stratified_split(
    df: DataFrame,
    label: str = "label",
    id: str = "review_id",
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Rows with a known label, plus ``split``; ``id`` must be unique.

    In each class the rows come in the order of their seeded hash; the first
    ``n_train`` train, the next ``n_val`` validate. No class is ever sorted: a histogram
    of hash prefixes tells which slot holds the last row of a side, only the rows of that
    slot (one in 65,536 of a class) are ranked, and every row is then compared with its
    class's two cut-off hashes, a table of one row per label.
    """
    known = df.filter(F.col(label).isin(*labels))
    key = shuffle_key(id, seed)
    slot = F.conv(F.substring(key, 1, _SLOT_DIGITS), 16, 10).cast("int")
    keyed = known.select(F.col(label), key.alias("_key"), slot.alias("_slot"))

    slots = keyed.groupBy(label, "_slot").agg(F.count("*").alias("n"))
    counts = slots.groupBy(label).agg(F.sum("n").alias("n"))
    quotas = split_quotas(counts, label, "n", val, test)
    cuts = quotas.select(
        label,
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("cut"), F.col("n_train").alias("rank")),
                F.struct(F.lit(2).alias("cut"), (F.col("n_train") + F.col("n_val")).alias("rank")),
            )
        ),
    )
    upto = Window.partitionBy(label).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    filled = slots.withColumn("_end", F.sum("n").over(upto))
    cut_slots = (
        filled.join(F.broadcast(cuts), label)
        .filter((F.col("rank") > F.col("_end") - F.col("n")) & (F.col("rank") <= F.col("_end")))
        .select(label, "_slot", "cut", (F.col("rank") - F.col("_end") + F.col("n")).alias("nth"))
    )
    nth = F.row_number().over(Window.partitionBy(label, "cut").orderBy("_key"))
    cut_keys = (
        keyed.join(F.broadcast(cut_slots), [label, "_slot"])
        .withColumn("_nth", nth)
        .filter(F.col("_nth") == F.col("nth"))
        .groupBy(label)
        .agg(
            F.max(F.when(F.col("cut") == 1, F.col("_key"))).alias("_train_to"),
            F.max(F.when(F.col("cut") == 2, F.col("_key"))).alias("_val_to"),
        )
    )
    side = (
        F.when(key <= F.col("_train_to"), F.lit("train"))
        .when(key <= F.col("_val_to"), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return (
        known.join(F.broadcast(cut_keys), label, "left")
        .withColumn("split", side)
        .select(*df.columns, "split")
    )


def class_weights(
    df: DataFrame, label: str = "label", labels: Sequence[str] = LABELS
) -> DataFrame:
    """``label``, ``label_id``, ``n`` and balanced ``weight`` = rows / (classes * n), one row
    per label. A label without rows is an error."""
    counts = df.filter(F.col(label).isin(*labels)).agg(
        *(F.count_if(F.col(label) == name).alias(f"n{i}") for i, name in enumerate(labels))
    )
    total = sum((F.col(c) for c in counts.columns), F.lit(0))
    rows = []
    for i, name in enumerate(labels):
        n = F.col(f"n{i}")
        weight = F.when(n > 0, total / (len(labels) * n)).otherwise(
            F.raise_error(F.lit(f"no rows labelled {name}")).cast("double")
        )
        rows.append(
            F.struct(
                F.lit(name).alias("label"),
                F.lit(i).alias("label_id"),
                n.alias("n"),
                weight.alias("weight"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


# Small groups are placed by a histogram of this many hash buckets.
_BUCKETS = 4096
SIDES = ("train", "val", "test")


def grouped_split(
    df: DataFrame,
    group: str,
    label: str = "label",
    id: str = "review_id",
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    labels: Sequence[str] = LABELS,
    large: int | None = None,
) -> DataFrame:
    """Rows with a known label, plus ``split``, such that all rows of a group (an author) are on one
    side and every class comes near its quotas (``1 - val - test``, ``val``, ``test``).

    Groups are counted by class first (a hot group is one row). Groups of at least ``large`` rows
    (default: a thousandth of all rows, so at most a thousand of them) go one by one, largest first,
    to the side where they leave the smallest squared distance to the quotas. The others are dealt
    by a seeded hash into ``4096`` buckets; a histogram of classes per bucket gives two cut points
    that best meet what is left of the quotas, so each class misses its quota by at most the rows of
    a bucket plus one large group. A row with a null group is a group by itself.
    """
    known = df.filter(F.col(label).isin(*labels))
    key = F.coalesce(F.col(group).cast("string"), F.concat(F.lit("\u0000row:"), F.col(id).cast("string")))
    keyed = known.withColumn("_group", key)
    classes = [F.count_if(F.col(label) == name).alias(f"_n{i}") for i, name in enumerate(labels)]
    groups = keyed.groupBy("_group").agg(F.count("*").alias("_n"), *classes)
    totals = groups.agg(*(F.sum(f"_n{i}").alias(f"t{i}") for i in range(len(labels))), F.sum("_n").alias("t")).first()
    if totals is None or not totals["t"]:
        return known.withColumn("split", F.lit(None).cast("string")).limit(0)
    shares = np.array([1 - val - test, val, test])
    target = np.outer(shares, [totals[f"t{i}"] for i in range(len(labels))]).astype(float)
    bound = large or max(1, totals["t"] // 1000)
    big = groups.filter(F.col("_n") >= bound).orderBy(F.desc("_n"), "_group").collect()  # at most 1000
    taken = np.zeros_like(target)
    placed = []
    for row in big:
        counts = np.array([row[f"_n{i}"] for i in range(len(labels))], float)
        costs = [((taken + np.eye(3)[s][:, None] * counts - target) ** 2).sum() for s in range(3)]
        side = int(np.argmin(costs))
        taken[side] += counts
        placed.append((row["_group"], SIDES[side]))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "_group"), F.lit(_BUCKETS)).cast("int")
    small = groups.filter(F.col("_n") < bound).groupBy(bucket.alias("b")).agg(
        *(F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(labels)))
    )
    hist = np.zeros((_BUCKETS, len(labels)))
    for row in small.collect():  # at most 4096 rows
        hist[row["b"]] = [row[f"_n{i}"] for i in range(len(labels))]
    before = np.vstack([np.zeros(len(labels)), np.cumsum(hist, axis=0)])  # rows 0..B
    left = target - taken
    whole = before[-1]
    best, cuts = None, (0, 0)
    for a in range(_BUCKETS + 1):
        train = before[a]
        rest = before[a:] - train  # val if cut at b >= a
        cost = ((train - left[0]) ** 2).sum() + ((rest - left[1]) ** 2).sum(1) + ((whole - train - rest - left[2]) ** 2).sum(1)
        b = int(np.argmin(cost))
        if best is None or cost[b] < best:
            best, cuts = cost[b], (a, a + b)
    spark = df.sparkSession
    sides = spark.createDataFrame(placed, "_group string, _side string") if placed else None
    by_hash = (
        F.when(bucket < cuts[0], F.lit("train")).when(bucket < cuts[1], F.lit("val")).otherwise(F.lit("test"))
    )
    rows = keyed.join(F.broadcast(sides), "_group", "left") if sides is not None else keyed.withColumn("_side", F.lit(None).cast("string"))
    return rows.select(*df.columns, F.coalesce("_side", by_hash).alias("split"))
