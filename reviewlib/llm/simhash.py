"""SimHash fingerprints of documents, and the search for fingerprints within a Hamming radius.

A fingerprint is 64 bits. Every feature of a text (word 3-shingles: three consecutive words, lower
case, words being runs of letters and digits; a text of one or two words is one feature of them
all) hashes to 64 bits; each occurrence votes +1 on the bits set in its hash and -1 on the others,
so a feature counts as often as it occurs (term-frequency weights). A bit of the fingerprint is set
where its votes are positive. A text without words (null, empty, only marks) has fingerprint 0.
Equal texts have equal fingerprints: the fingerprint is a function of the text alone.

Word hashes are computed in the JVM (``xxhash64`` of each word); only the arrays of word hashes go
to Python, where numpy forms the shingles and counts the votes of a whole batch at once.

:func:`within` finds, for every fingerprint, how many others lie within a Hamming radius, by
permuted block tables: the 64 bits are cut into ``radius + 3`` blocks; two fingerprints that differ
in at most ``radius`` bits agree on at least 3 whole blocks, so they meet in one of the tables
keyed by 3 of the blocks. A pair is counted only in the first table where it meets. Tables are
joined with themselves by key; a key held by very many fingerprints is cut into chunks, one side
dealt over them and the other copied to each, so no task sees more than ``CHUNK`` fingerprints of
one side.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Features hashed per numpy step; each takes 64 bytes of votes.
_STEP = 1 << 15
# Words of the texts that one call fingerprints at most (one text at least).
_WORDS = 1 << 17
# Fingerprints of one key and side that one task compares at most.
CHUNK = 4096
RADIUS = 3
_WORD = r"([\p{L}\p{N}]+)"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: Column) -> Column:
    """``xxhash64`` of each lower-cased word of ``text``, in order; empty for a null text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), 1)
    return F.transform(words, lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), so neighbouring inputs spread over all bits."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _features(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the index of the text each belongs to."""
    lengths = np.diff(offsets)
    n = len(hashes)
    pad = np.concatenate([hashes, np.zeros(2, np.uint64)])
    # Shingle i starts at word i; it is whole while i + 2 is inside its text.
    owner = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.arange(n)
    whole = starts + 2 < offsets[1:][owner] if n else np.zeros(0, bool)
    # A text of one or two words is one feature, starting at its first word, the rest zero.
    short = np.flatnonzero((lengths > 0) & (lengths < 3))
    first = offsets[:-1][short]
    a = np.concatenate([pad[starts[whole]], pad[first]])
    b = np.concatenate([pad[starts[whole] + 1], np.where(lengths[short] > 1, pad[first + 1], 0)])
    c = np.concatenate([pad[starts[whole] + 2], np.zeros(len(short), np.uint64)])
    who = np.concatenate([owner[whole], short])
    order = np.argsort(who, kind="stable")
    mixed = _mix(a * _GOLDEN ^ _rotl(b, 21) ^ _rotl(c, 42))
    return mixed[order], who[order]


def fingerprints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint (int64) of each text, given its word hashes as a flat array with offsets."""
    feats, who = _features(hashes.astype(np.uint64, copy=False), offsets)
    texts = len(offsets) - 1
    votes = np.zeros((texts, 64), np.int64)
    count = np.bincount(who, minlength=texts).astype(np.int64)
    for lo in range(0, len(feats), _STEP):
        part = feats[lo : lo + _STEP]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        _add_rows(votes, who[lo : lo + _STEP], bits)
    positive = 2 * votes > count[:, None]
    return np.packbits(positive, axis=1, bitorder="little").view("<u8").ravel().view(np.int64)


def _add_rows(votes: np.ndarray, who: np.ndarray, bits: np.ndarray) -> None:
    """Adds each row of ``bits`` to the row ``who`` of ``votes``; ``who`` ascends."""
    if not len(who):
        return
    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    votes[who[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _batch_fingerprints(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(pa.scalar([], column.type)) if column.null_count else column
    offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
    values = column.values.to_numpy(zero_copy_only=False) if len(column.values) else np.zeros(0, np.int64)
    values = values[column.offsets[0].as_py() : column.offsets[0].as_py() + offsets[-1]]
    return pa.array(fingerprints(values.view(np.uint64), offsets), pa.int64())


def add_fingerprints(df: DataFrame, hashes: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``{new: column}`` of ``hashes``, a long column ``new``: the fingerprint
    of the word hashes in ``column`` (an array of longs from :func:`word_hashes`). The hash columns
    are dropped; any other column of the name ``new`` is replaced."""
    dropped = set(hashes) | set(hashes.values())
    kept = [f for f in df.schema.fields if f.name not in dropped]
    out = T.StructType(kept + [T.StructField(n, T.LongType()) for n in hashes])
    names = [f.name for f in kept]
    sources = list(hashes.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = [whole.schema.get_field_index(s) for s in sources]
            words = sum(pc.list_value_length(whole.column(i)).fill_null(0).to_numpy(zero_copy_only=False) for i in at)
            ends = np.cumsum(words) if len(words) else np.zeros(0, np.int64)
            lo = 0
            while lo < whole.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + _WORDS, side="right")))
                batch = whole.slice(lo, hi - lo)
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                made = [_batch_fingerprints(batch.column(i)) for i in at]
                yield pa.RecordBatch.from_arrays(columns + made, names=out.names)
                lo = hi

    return df.mapInArrow(run, out)


def hex64(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """1 - (differing bits) / 64: 1 for equal fingerprints, 0 for complements."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)).cast("double") / 64


def _masks(radius: int) -> list[int]:
    """Bit masks of the tables: each 3 of ``radius + 3`` near equal blocks of the 64 bits."""
    blocks = radius + 3
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges[:-1], edges[1:])]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), 3)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def within(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """For every distinct ``fp`` (long) of ``fps``: ``fp``, ``n`` (its rows), ``n_near`` (rows of
    other fingerprints at most ``radius`` bits away). Null fingerprints are left out."""
    masks = _masks(radius)
    distinct = fps.filter(F.col("fp").isNotNull()).groupBy("fp").agg(F.count("*").alias("n"))
    keyed = distinct.select(
        "fp", "n", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("t", "key")
    )
    sizes = keyed.groupBy("t", "key").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    # Spark takes rows of an array for no larger than their input, so it would broadcast these tables
    keyed = keyed.join(sizes.hint("merge"), ["t", "key"])
    left = keyed.select("t", "key", "fp", (F.abs(F.xxhash64("fp")) % F.col("parts")).cast("int").alias("part"))
    right = keyed.select(
        "t", "key", F.col("fp").alias("other"), F.col("n").alias("n_other"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    earlier = [F.lit(False)]
    for i, m in enumerate(masks):
        same = F.col("fp").bitwiseAND(F.lit(m)) == F.col("other").bitwiseAND(F.lit(m))
        earlier.append(F.when(F.col("t") > i, same).otherwise(F.lit(False)))
    first = ~F.greatest(*earlier)
    pairs = left.join(right.hint("merge"), ["t", "key", "part"]).filter(
        (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius) & first
    )
    near = pairs.groupBy("fp").agg(F.sum("n_other").alias("n_near"))
    return distinct.join(near, "fp", "left").select(
        "fp", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    )
