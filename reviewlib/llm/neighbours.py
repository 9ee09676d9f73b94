"""Each row beside the next one in a total order, cyclically, without gathering the order in a task.

Rows are cut into ranges of the order by splitters drawn from a sample (the sample only balances
the ranges; the result does not depend on it). The first row of every range is copied, as a
guest, to the range before it (the first row of all to the last range), so a window over one
range at a time finds every row's successor. Only the rows, plus one guest per range, are
exchanged once; no range holds more than about its share, since ties of the order are broken by
a row number taken from the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows sampled per range to place the splitters.
_SAMPLE = 64


def _bin_of(key: Column, probes: list[Column]) -> Column:
    """How many of the ascending ``probes`` are at or below ``key``, by binary search."""
    if not probes:
        return F.lit(0)
    array = F.array(*probes)
    top = 1 << (len(probes).bit_length() - 1)
    steps = F.lit([top >> i for i in range(top.bit_length())])

    def further(low: Column, step: Column) -> Column:
        passed = F.coalesce(F.get(array, low + step - 1) <= key, F.lit(False))
        return low + F.when(passed, step).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), further)


def _literal(row, names: Sequence[str], types: Sequence[str]) -> Column:
    return F.struct(*(F.lit(row[n]).cast(t).alias(n) for n, t in zip(names, types)))


def with_next(df: DataFrame, order: Sequence[Column], carry: Sequence[str], prefix: str = "next_") -> DataFrame:
    """``df`` with, for each column ``c`` of ``carry``, ``prefix + c``: its value in the row that
    follows in ascending ``order`` (non-null columns); the last row is followed by the first,
    and a lone row by itself. Rows equal in ``order`` follow each other in input order. Columns
    named ``_k``, ``_part``, ``_guest`` or ``prefix + c`` in ``df`` are replaced. No rows give
    no rows."""
    names = [f"_o{i}" for i in range(len(order))] + ["_rid"]
    out = [c for c in df.columns if c not in {"_k", "_part", "_guest"} | {prefix + c for c in carry}]
    rows = df.select(*out).withColumn(
        "_k", F.struct(*(o.alias(n) for o, n in zip(order, names[:-1])), F.monotonically_increasing_id().alias("_rid"))
    )
    types = [f.dataType.simpleString() for f in rows.schema["_k"].dataType.fields]
    parts = max(1, rows.rdd.getNumPartitions())
    total = rows.count()
    if total == 0:
        return rows.select(*out, *(F.col(c).alias(prefix + c) for c in carry)).limit(0)
    fraction = min(1.0, _SAMPLE * parts / total)
    sample = [r["_k"] for r in rows.select("_k").sample(fraction=fraction, seed=7).orderBy("_k").collect()]
    probes = [_literal(k, names, types) for k in sample[_SAMPLE::_SAMPLE]]
    placed = rows.withColumn("_part", _bin_of(F.col("_k"), probes))
    firsts = placed.groupBy("_part").agg(F.min("_k").alias("_k")).collect()  # a row per range
    present = sorted(r["_part"] for r in firsts)
    before = {p: present[i - 1] for i, p in enumerate(present)}  # the first range's goes to the last
    spark = df.sparkSession
    guests_at = spark.createDataFrame(
        [(r["_k"], before[r["_part"]]) for r in firsts], f"_k {rows.schema['_k'].dataType.simpleString()}, _to int"
    )
    guests = placed.join(F.broadcast(guests_at), "_k").select(
        *out, "_k", F.col("_to").alias("_part"), F.lit(True).alias("_guest")
    )
    both = placed.withColumn("_guest", F.lit(False)).unionByName(guests)
    window = Window.partitionBy("_part").orderBy("_guest", "_k")
    return (
        both.select("*", *(F.lead(c).over(window).alias(prefix + c) for c in carry))
        .filter(~F.col("_guest"))
        .select(*out, *(prefix + c for c in carry))
    )
