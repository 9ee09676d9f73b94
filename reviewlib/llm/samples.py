"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 20


def bounded_sample(rows: DataFrame, by: str, id: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most of each value of ``by``: all rows of a small group, an equal share
    of a larger one, chosen by a hash of the id, so that the choice is the same each time.

    ``by`` has few values, since a model has a part for each of them; their shares are broadcast, so
    no row is shuffled."""
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    share = counts.select(by, F.least(F.lit(_SCALE), F.floor(F.lit(bound * _SCALE) / F.col("_n"))).alias("_share"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), id), F.lit(_SCALE))
    return rows.join(F.broadcast(share), by).filter(draw < F.col("_share")).drop("_share")
