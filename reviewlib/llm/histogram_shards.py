"""Shards of near equal bytes by histogram sort: splitters from counts, then one exchange.

DataFrame functions only.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.llm.common import bin_of, stored

LAW = "bytes"
N_SHARDS = 24
# Each round cuts the range around every open splitter into so many parts.
PROBES = 32
# A splitter may be off by this share of a shard's bytes.
TOLERANCE = 1 / 1000
# Each shard is sorted and numbered in at least so many separate bins.
BINS = 8

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _below(rows: DataFrame, key: str, size: str, probes: list[int]) -> list[int]:
    """Exact bytes of the rows whose key is below each probe. Only counts per bin move, and
    there are no more bins than probes."""
    bins = rows.groupBy(bin_of(F.col(key), probes).alias("bin")).agg(F.sum(size).alias("bytes"))
    found = dict(bins.collect())  # at most len(probes) + 1 rows
    total, out = 0, []
    for i in range(len(probes)):
        total += found.get(i, 0)
        out.append(total)
    return out


def splitters(
    rows: DataFrame,
    key: str = "key",
    size: str = "size",
    parts: int = N_SHARDS,
    tolerance: float = TOLERANCE,
    probes: int = PROBES,
) -> list[int]:
    """``parts - 1`` keys that cut ``rows`` into parts of near equal ``size``.

    Every round counts the bytes below all open probes in one pass, keeps for each cut the
    narrowest range around its target, and probes that range more finely, until
    each cut is within tolerance or its range is a single key.
    """
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0]
    targets = [total * i // parts for i in range(1, parts)]
    slack = total / parts * tolerance
    known = {_LOW: 0, _HIGH: total}
    while True:
        keys = sorted(known)
        ask: set[int] = set()
        for target in targets:
            if min(abs(known[k] - target) for k in keys) <= slack:
                continue
            at = bisect_left(keys, target, key=known.__getitem__)
            low, high = keys[max(0, at - 1)], keys[min(at, len(keys) - 1)]
            width = high - low
            ask.update(
                k for i in range(1, probes) if low < (k := low + width * i // probes) < high
            )
        if not ask:
            break
        asked = sorted(ask)
        known.update(zip(asked, _below(rows, key, size, asked)))
    cuts = [min(keys, key=lambda k: (abs(known[k] - target), k)) for target in targets]
    return sorted(cuts)


def shard(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    tolerance: float = TOLERANCE,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of every row.

    A row's size is the UTF-8 bytes of its text plus 8, of a null text 8. Rows are ordered by a
    hash of id, text and the row's number in the input (taken once, when the rows are written to
    the shared folder), so that copies are not next to each other and repeated rows, or rows
    with null id and text, spread like all others; shards are ranges of that order with bytes
    equal within the tolerance and a row's size. ``slot`` numbers a shard's rows from 0 in that
    order. Repeated rows get slots of their own. No rows give no shards.

    A shard is never gathered: it is cut into bins, each counted, sorted and numbered by itself,
    and a bin's first slot is the number of rows in the bins before it.
    """
    value = F.col(text).cast("string")
    body = F.coalesce(value, F.lit(""))
    rows = stored(
        docs.select(
            F.col(id).cast("long").alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(
                F.coalesce(F.col(id).cast("string"), F.lit("")), body, F.monotonically_increasing_id()
            ).alias("key"),
        )
    )
    cuts = splitters(rows, parts=n_shards, tolerance=tolerance)
    # bins follow the session's shuffle setting, so that tasks stay small as rows grow
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_shard = max(BINS, -(-2 * tasks // n_shards))
    edges = [_LOW, *cuts, _HIGH]
    bounds = [
        low + (high - low) * i // per_shard
        for low, high in zip(edges, edges[1:])
        for i in range(per_shard)
    ]
    binned = rows.withColumn("bin", bin_of(F.col("key"), bounds[1:]))
    counts = dict(binned.groupBy("bin").agg(F.count("*").alias("n")).collect())  # a row per bin
    first, seen = [], 0
    for b in range(len(bounds)):
        if b % per_shard == 0:
            seen = 0
        first.append(seen)
        seen += counts.get(b, 0)
    within = Window.partitionBy("bin").orderBy("key", "doc_id", "text_crc32", "size")
    return binned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.floor(F.col("bin") / per_shard).cast("int").alias("shard"),
        (F.get(F.lit(first), F.col("bin")) + F.row_number().over(within) - 1)
        .cast("long")
        .alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_bytes(sharded: DataFrame) -> DataFrame:
    """``shard``, ``rows``, ``bytes`` of a sharding."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes")
    )
