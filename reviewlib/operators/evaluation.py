"""Scores of predicted labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.patterns import LABELS
from reviewlib.operators.split import encode_label

# Probabilities are kept this far from 0 and 1 before the logarithm.
_EPSILON = 1e-7


def accuracy_and_loss(
    df: DataFrame,
    label: str = "label",
    pred: str = "pred",
    p: str = "p",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """One row: ``test_acc`` and ``test_loss``, the mean negative log probability of the true
    label. ``p`` is an array in label order."""
    true_p = F.get(p, encode_label(label, labels))
    clipped = F.greatest(F.least(true_p, F.lit(1 - _EPSILON)), F.lit(_EPSILON))
    return df.agg(
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("test_acc"),
        F.avg(-F.log(clipped)).alias("test_loss"),
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", pred: str = "pred", labels: Sequence[str] = LABELS
) -> DataFrame:
    """A row per true label, a column ``pred_<label>`` per predicted one. One pass that
    leaves a single row of counts, so skewed classes do not matter."""
    counts = df.agg(
        *(
            F.count_if((F.col(label) == t) & (F.col(pred) == q)).alias(f"n{i}_{j}")
            for i, t in enumerate(labels)
            for j, q in enumerate(labels)
        )
    )
    rows = [
        F.struct(
            F.lit(t).alias("label"),
            *(F.col(f"n{i}_{j}").alias(f"pred_{q}") for j, q in enumerate(labels)),
        )
        for i, t in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _per_class(df: DataFrame, label: str, pred: str, labels: Sequence[str]) -> DataFrame:
    true, guess = F.col(label), F.col(pred)
    known = df.filter(true.isin(*labels))
    counts = known.agg(
        *(F.count_if((true == name) & (guess == name)).alias(f"hit{i}") for i, name in _n(labels)),
        *(F.count_if(guess == name).alias(f"pred{i}") for i, name in _n(labels)),
        *(F.count_if(true == name).alias(f"true{i}") for i, name in _n(labels)),
    )
    rows = []
    for i, name in _n(labels):
        hit, predicted, support = (F.col(f"{c}{i}") for c in ("hit", "pred", "true"))
        rows.append(
            F.struct(
                F.lit(name).alias("label"),
                _ratio(hit, predicted).alias("precision"),
                _ratio(hit, support).alias("recall"),
                _ratio(2 * hit, predicted + support).alias("f1"),
                support.alias("support"),
                hit.alias("hits"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def _n(labels: Sequence[str]) -> list[tuple[int, str]]:
    return list(enumerate(labels))


_SCORES = ("precision", "recall", "f1")


def classification_report(
    df: DataFrame, label: str = "label", pred: str = "pred", labels: Sequence[str] = LABELS
) -> DataFrame:
    """``precision``, ``recall``, ``f1`` and ``support`` per label, then their plain
    (``macro avg``) and support-weighted (``weighted avg``) means."""
    classes = _per_class(df, label, pred, labels)
    macro = [F.avg(c).alias(c) for c in _SCORES]
    weighted = [_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")) for c in _SCORES]
    averages = classes.agg(
        F.array(
            F.struct(
                F.lit("macro avg").alias("label"), *macro, F.sum("support").alias("support")
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *(w.alias(c) for w, c in zip(weighted, _SCORES)),
                F.sum("support").alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return classes.drop("hits").unionByName(averages)


def compute_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", labels: Sequence[str] = LABELS
) -> DataFrame:
    """One row: ``accuracy``, ``macro_f1``, ``weighted_f1``, ``n``."""
    return _per_class(df, label, pred, labels).agg(
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
    )
