"""Running totals and first-n per group when one group may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2^14 consecutive ids make one block.
_BLOCK_BITS = 14


def id_block(ord: str, bits: int = _BLOCK_BITS) -> Column:
    """Block number of an integer id. Ids are unique per group, so a block of a group has
    at most ``2**bits`` rows however many rows the group has."""
    return F.shiftright(ord, bits)


def running_total(
    df: DataFrame, group: Sequence[str], block: str, order: Sequence[str], step: str, out: str
) -> DataFrame:
    """``out``: sum of ``step`` over the rows of the same group up to this one.

    A window over the group would sort a large group in one task. Here only its block
    totals are summed that way; each total joins its block as one more row, sorted first,
    and the running sum stays within the block. Blocks must follow ``order``.
    """
    totals = df.groupBy(*group, block).agg(F.sum(step).alias(step))
    earlier = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *group,
        block,
        F.coalesce(F.sum(step).over(earlier), F.lit(0)).alias(step),
        F.lit(True).alias("_carried"),
    )
    rows = df.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    within = (
        Window.partitionBy(*group, block)
        .orderBy(F.col("_carried").desc(), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn(out, F.sum(step).over(within)).filter(~F.col("_carried")).drop("_carried")
    )


def first_per_group(df: DataFrame, group: str, ord: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the smallest ``ord`` (an integer id)."""
    counted = df.withColumn("_block", id_block(ord)).withColumn("_one", F.lit(1))
    numbered = running_total(counted, [group], "_block", [ord], "_one", "_nth")
    return numbered.filter(F.col("_nth") <= n).drop("_block", "_one", "_nth")
