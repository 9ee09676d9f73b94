"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.text import named


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions that a later filter uses.

    The optimizer pushes a filter below a projection by copying the projection's
    expressions into it, and a chain of regular expressions is then evaluated
    for the filter and again for the result. It does not push filters through the expansion
    of an array, here of one struct. All of ``columns`` are computed, used or not.
    """
    order = [*df.columns, *(c for c in columns if c not in df.columns)]
    kept = [named(c) for c in df.columns if c not in columns]
    new = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(*kept, F.inline(F.array(new))).select(*(named(c) for c in order))
