"""Weak labels from several noisy raters, reconciled by expectation-maximisation (Dawid and Skene).

Observations are rows (``item``, ``rater``, ``label``); a rater may skip items. Items with the same
observations have the same posterior, so they are counted by pattern (how often each rater gave
each label) first, and the rounds run over patterns weighted by their items: few raters make few patterns,
however many items there are. The model has a
prior over the true classes and, for every rater, a confusion matrix (true class to given label).
Each round is two aggregates: the E-step joins observations with the log confusion entries (a
table of raters x classes x labels, small and broadcast), sums them per (pattern, class) and
normalises to posteriors; the M-step sums posteriors per (rater, class, label) and per class.
Only the prior and the confusion matrices reach the driver. Rounds stop when no number moves by
more than ``tol``, or after ``rounds``. Posteriors are written to the scratch folder each round.

It starts from majority voting (each item's labels counted), as is usual, and smooths counts by
``smoothing`` so that no entry is zero.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.patterns import LABELS
from reviewlib.scratch import scratch_dir


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _estimate(posterior: DataFrame, seen: DataFrame, raters: list[str], k: int, smoothing: float):
    """Prior and confusion matrices from posteriors (``pid``, ``items``, ``c``, ``p``)."""
    prior = np.full(k, smoothing)
    weight = F.col("items") * F.col("p")
    for row in posterior.groupBy("c").agg(F.sum(weight).alias("p")).collect():  # k rows
        prior[row["c"]] += row["p"]
    prior /= prior.sum()
    confusion = np.full((len(raters), k, k), smoothing)
    joined = seen.join(posterior, "pid").groupBy("rater", "c", "label").agg(F.sum(weight * F.col("times")).alias("p"))
    for row in joined.collect():  # raters x classes x labels rows
        confusion[raters.index(row["rater"]), row["c"], row["label"]] += row["p"]
    confusion /= confusion.sum(axis=2, keepdims=True)
    return prior, confusion


def reconcile(
    observations: DataFrame,
    labels: Sequence[str] = LABELS,
    rounds: int = 50,
    tol: float = 1e-9,
    smoothing: float = 0.01,
) -> tuple[DataFrame, np.ndarray, dict[str, np.ndarray]]:
    """Posteriors (``item``, ``p``: array in label order), the prior, and each rater's confusion
    matrix. Observations with a null item, rater or a label outside ``labels`` are left out; an
    item without observations has no row."""
    spark = observations.sparkSession
    k = len(labels)
    code = F.array_position(F.lit(list(labels)), F.col("label")).cast("int") - 1
    given = (
        observations.filter(F.col("item").isNotNull() & F.col("rater").isNotNull())
        .select("item", F.col("rater").cast("string").alias("rater"), code.alias("label"))
        .filter(F.col("label") >= 0)
        .groupBy("item", "rater", "label").agg(F.count("*").alias("times"))
    )
    # at most raters x labels entries an item
    pattern = F.sort_array(F.collect_list(F.struct("rater", "label", "times"))).alias("pattern")
    items = _stored(given.groupBy("item").agg(pattern))
    patterns = items.groupBy("pattern").agg(F.count("*").alias("items"))
    patterns = _stored(patterns.withColumn("pid", F.monotonically_increasing_id()))
    seen = _stored(patterns.select("pid", "items", F.inline("pattern")))
    raters = sorted(r["rater"] for r in seen.select("rater").distinct().collect())  # few raters
    votes = seen.groupBy("pid", "items", F.col("label").alias("c")).agg(F.sum("times").cast("double").alias("n"))
    total = votes.groupBy("pid").agg(F.sum("n").alias("t"))
    posterior = _stored(votes.join(total, "pid").select("pid", "items", "c", (F.col("n") / F.col("t")).alias("p")))
    seen = seen.drop("items")
    sizes = patterns.select("pid", "items")
    prior, confusion = _estimate(posterior, seen, raters, k, smoothing)
    for _ in range(rounds):
        logs = spark.createDataFrame(
            [(r, c, l, float(np.log(confusion[i, c, l]))) for i, r in enumerate(raters) for c in range(k) for l in range(k)],
            "rater string, c int, label int, lg double",
        )
        scored = seen.join(F.broadcast(logs), ["rater", "label"]).groupBy("pid", "c").agg(
            F.sum(F.col("lg") * F.col("times")).alias("lg")
        )
        with_prior = scored.withColumn("lg", F.col("lg") + F.element_at(F.lit([float(v) for v in np.log(prior)]), F.col("c") + 1))
        top = with_prior.groupBy("pid").agg(F.max("lg").alias("m"))
        shifted = with_prior.join(top, "pid").withColumn("e", F.exp(F.col("lg") - F.col("m")))
        sums = shifted.groupBy("pid").agg(F.sum("e").alias("s"))
        posterior = _stored(
            shifted.join(sums, "pid").join(sizes, "pid").select("pid", "items", "c", (F.col("e") / F.col("s")).alias("p"))
        )
        new_prior, new_confusion = _estimate(posterior, seen, raters, k, smoothing)
        moved = max(np.abs(new_prior - prior).max(), np.abs(new_confusion - confusion).max())
        prior, confusion = new_prior, new_confusion
        if moved <= tol:
            break
    arrays = posterior.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("c", "p"))).alias("cp"))
    found = arrays.join(patterns, "pid").select("pattern", F.transform("cp", lambda x: x["p"]).alias("p"))
    return items.join(found, "pattern").select("item", "p"), prior, {r: confusion[i] for i, r in enumerate(raters)}
