"""Benchmark items inside documents: MinHash containment search by size, checked exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.llm.common import id_and_text, stored
from reviewlib.llm.words import Coder, windows

WIDTH = 5
PERCENT = 80


def _item_shingles(items: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """``item_id``, ``words`` (of a shingle), ``n_item`` (distinct shingles), ``nth`` (from 0, by
    ascending hash), ``shingle``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            for group in coder.groups(batch.column(1)):
                for row, (a, b) in enumerate(zip(group.bounds[:-1], group.bounds[1:])):
                    if a == b:
                        continue
                    words = min(width, int(b - a))
                    found = np.unique(windows(group.codes[a:b], words))
                    n = len(found)
                    item = batch.column(0)[group.lo + row]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item.as_py()] * n, pa.int64()),
                            pa.array(np.full(n, words, np.int32)),
                            pa.array(np.full(n, n, np.int64)),
                            pa.array(np.arange(n, dtype=np.int64)),
                            pa.array(found.view(np.int64)),
                        ],
                        names=["item_id", "words", "n_item", "nth", "shingle"],
                    )

    rows = items.select(F.col(id).cast("long").alias("item_id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(
        run, "item_id long, words int, n_item long, nth long, shingle long"
    )


def _needed(n: Column, percent: int) -> Column:
    """How many of ``n`` shingles must be found."""
    return F.ceil(n * percent / F.lit(100.0)).cast("long")


def _document_hits(
    docs: DataFrame, bits: np.ndarray, widths: list[int]
) -> DataFrame:
    """``doc_id``, ``shingle`` of a document's distinct shingles that may belong to an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for group in coder.groups(batch.column(1)):
                for width in widths:
                    found = windows(group.codes, width)
                    at = np.flatnonzero(_maybe(bits, found))
                    if not len(at):
                        continue
                    row = np.searchsorted(group.bounds, at, "right") - 1
                    inside = at + width <= group.bounds[row + 1]
                    row, at = row[inside], at[inside]
                    pairs = np.unique(np.stack([row.astype(np.uint64), found[at]]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[group.lo + pairs[0].astype(np.int64)], pa.int64()),
                            pa.array(np.ascontiguousarray(pairs[1]).view(np.int64)),
                        ],
                        names=["doc_id", "shingle"],
                    )

    return docs.mapInArrow(run, "doc_id long, shingle long").distinct()


_SLOTS = 24


def _maybe(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    slot = (codes >> np.uint64(64 - _SLOTS)).astype(np.int64)
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


def _bits(shingles: DataFrame) -> np.ndarray:
    """A bitmap of 2 MB, whatever the number of items, of the shingles in them."""
    slot = F.shiftrightunsigned("shingle", 64 - _SLOTS)
    words = shingles.select(
        F.shiftright(slot, 6).cast("int").alias("word"),
        F.expr("shiftleft(1L, cast(shiftrightunsigned(shingle, 40) & 63 as int))").alias("bit"),
    )
    out = np.zeros(1 << (_SLOTS - 6), np.int64)
    for word, bit in words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toLocalIterator():
        out[word] = bit
    return out


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """Pairs (``doc_id``, ``item_id``) in which the document has at least ``percent`` of the item's
    distinct word shingles, with ``n_item`` and ``n_common``.

    A-Z count as a-z. An item with fewer than ``width`` words is one shingle of all its words; one
    without words, or a null id or text, matches nothing. Rows that repeat an id count as one
    with the shingles of all.

    An item's bottom-k MinHash sketch is its k smallest shingle hashes. With k one more than may
    be missing, a document that contains enough of the item has one of the k, so no match
    is lost. Items come in size bands (powers of two), each with the k of its largest size, and
    documents of any length are probed with all their shingles. A bitmap of fixed size
    keeps the shingles that no item has from being shuffled; candidates are then counted exactly.
    """
    items = stored(_item_shingles(items, item_id, item_text, width).distinct())
    sizes = items.groupBy("item_id").agg(F.count_distinct("shingle").alias("n_item"))
    items = stored(
        items.select("item_id", "words", "nth", "shingle").join(sizes, "item_id")
    )
    widths = sorted(r[0] for r in items.select("words").distinct().collect())  # at most ``width`` rows
    found = stored(
        _document_hits(id_and_text(docs).filter("doc_id IS NOT NULL"), _bits(items), widths)
    )
    band = F.pow(F.lit(2.0), F.ceil(F.log2("n_item"))).cast("long")
    sketch = items.filter(F.col("nth") <= band - _needed(band, percent)).select("item_id", "shingle")
    candidates = found.join(sketch, "shingle").select("doc_id", "item_id").distinct()
    wanted = candidates.join(items.select("item_id", "shingle", "n_item").distinct(), "item_id")
    common = wanted.join(found, ["doc_id", "shingle"], "left_semi")
    counts = common.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_common"))
    return counts.filter(F.col("n_common") * 100 >= F.col("n_item") * percent)
