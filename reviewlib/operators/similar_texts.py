"""Similarity graph of texts: the pairs of :mod:`reviewlib.operators.similarity`, for vectors of one text each.

Entries of vectors are never shuffled. Texts are cut into chunks of some megabytes; a chunk is one row with its own
vocabulary, its texts' terms as places in it, packed, and their counts. Only the vocabularies of chunks move, to learn how
many ids have a term and to give the term a number. Equal vectors form classes, as there, and blocks are the vectors of
representatives.

Every block meets every other in a Cartesian product, which reads them again and shuffles nothing. Within two blocks the search
is exact: terms are put into groups (heavy ones alone, others by a hash of their number), and the cosine of two vectors
is at most the dot product of their lengths per group (Cauchy and Schwarz). Two matrix products, over few groups and, for
the rows and columns that pass in a tile, over many, leave few pairs, whose whole vectors are multiplied.
The work grows with the square of the texts; memory is that of two blocks, and the disk that of the texts and of the pairs found.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.functions.patterns import PUNCTUATION
from reviewlib.operators.similarity import DIGITS, SAME, _stored, classes_of, term_counts

# Bytes of text in a chunk, about.
_CHUNK = 1 << 24
# Texts and entries of a block at most (one text at least), and texts of a tile.
_DOCS, _ENTRIES, _TILE = 8192, 1 << 21, 256
# Groups of terms, of which heavy terms alone, in the first and in the second product.
_FEW, _MANY = (192, 32), (2048, 256)
# What a product of lengths in single precision may miss.
_MISS = 1e-4
# Partitions of blocks at most; tasks are their square.
_PARTS = 32
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def packed(a: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers byte by byte, the like bytes of all together."""
    a = a.astype(kind)
    return pa.compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def unpacked(data: bytes, n: int, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, n).T).view(kind).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _counted(part: pa.RecordBatch) -> tuple | None:
    """Of rows (``id``, ``text``, or ``terms`` and ``tfs``): the rows with a term, how many each has, their places in the
    vocabulary and counts, the vocabulary, and how many rows have each of it."""
    words = pc.ascii_split_whitespace(part.column("text").cast(pa.large_string()))
    each = words.flatten().dictionary_encode()
    bare = pc.replace_substring_regex(pc.ascii_lower(each.dictionary), PUNCTUATION, "")
    given = part.column("terms").cast(pa.large_list(pa.large_string()))
    terms = pa.concat_arrays([bare, given.flatten()]).dictionary_encode()
    code = terms.indices.to_numpy().astype(np.int64)
    rows = np.arange(part.num_rows)
    of = np.concatenate([np.repeat(rows, pc.list_value_length(x).fill_null(0).to_numpy(zero_copy_only=False)) for x in (words, given)])
    at = np.concatenate([code[: len(bare)][each.indices.to_numpy()], code[len(bare) :]])
    n = np.concatenate([np.ones(len(each), np.int64), part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)])
    wide = max(1, len(terms.dictionary))
    empty = pc.index(terms.dictionary, pa.scalar("", pa.large_string())).as_py()
    key, place = np.unique((of * wide + at)[at != empty], return_inverse=True)
    if not len(key):
        return None
    tfs = np.bincount(place, n[at != empty]).astype(np.int64)
    used, codes = np.unique(key % wide, return_inverse=True)
    kept, sizes = np.unique(key // wide, return_counts=True)
    return kept, sizes, codes, tfs, terms.dictionary.take(pa.array(used)), np.bincount(codes)


def chunks_of(df: DataFrame, id: str, text: str) -> DataFrame:
    """Rows of texts with their ``ids`` (with a term), how many terms each has, the places of these in the chunk's ``terms``,
    their counts, and how many ids have each term (``dfs``). Texts of a repeated id are counted together first."""
    rows = df.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    repeated = _stored(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"))
    counts = term_counts(rows.join(repeated, "id", "left_semi"), "id", "text")
    whole = counts.groupBy("id").agg(F.collect_list(F.struct("term", "tf")).alias("x"))
    none = (F.lit(None).cast("array<string>").alias("terms"), F.lit(None).cast("array<bigint>").alias("tfs"))
    rows = rows.join(repeated, "id", "left_anti").select("id", "text", *none).unionByName(
        whole.select("id", F.lit(None).cast("string").alias("text"), F.col("x.term").alias("terms"), F.col("x.tf").alias("tfs"))
    )
    kind = T.ArrayType(rows.schema["id"].dataType)
    out = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", kind), T.StructField("sizes", T.ArrayType(T.IntegerType()))])
    out = out.add("codes", T.BinaryType()).add("tfs", T.BinaryType()).add("terms", T.ArrayType(T.StringType())).add("dfs", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            size += 12 * pc.list_value_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False)
            ends, lo = np.cumsum(size), 0
            while lo < len(ends):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _CHUNK)))
                part = batch.slice(lo, hi - lo)
                lo = hi
                if found := _counted(part):
                    kept, sizes, codes, tfs, terms, dfs = found
                    ids = part.column(0).take(pa.array(kept))
                    lists = [ids, pa.array(sizes, pa.int32()), terms.cast(pa.string()), pa.array(dfs, pa.int32())]
                    ids, sizes, terms, dfs = (pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)
                    columns = [pa.array([chunk]), ids, sizes, pa.array([packed(codes)]), pa.array([packed(tfs)]), terms, dfs]
                    yield pa.RecordBatch.from_arrays(columns, names=out.names)
                    chunk += 1

    return _stored(rows.mapInArrow(run, out))


def _vectors(row: dict, total: int) -> tuple:
    """Of a chunk with its numbered terms: offsets of texts, and by text and term number the numbers (-1: a term of no
    other id), counts, ``df`` and weights of its entries, and the lengths before scaling."""
    sizes = row["sizes"].values.to_numpy().astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    codes, tfs = (unpacked(row[c].as_py(), int(at[-1])).astype(np.int64) for c in ("codes", "tfs"))
    tids, dfs = np.full(codes.max() + 1, -1), np.ones(codes.max() + 1, np.int64)
    if row["v"].is_valid:
        v = row["v"].values
        pos = v.field("pos").to_numpy()
        tids[pos], dfs[pos] = v.field("tid").to_numpy(), v.field("df").to_numpy()
    of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((tids[codes], of))
    codes, tfs = codes[order], tfs[order]
    raw = tfs * (np.log((total + 1) / (dfs[codes] + 1)) + 1)
    norms = np.sqrt(np.add.reduceat(raw * raw, at[:-1]))
    return at, tids[codes], tfs, dfs[codes], raw / norms[of], norms


def _placed(df: DataFrame, id: str, text: str) -> tuple[DataFrame, int]:
    """The chunks with the number and ``df`` of each term that several ids have, and the number of ids."""
    chunks = chunks_of(df, id, text)
    total = int(chunks.select(F.sum(F.size("ids"))).first()[0] or 0)
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("terms", "dfs")).alias("pos", "x"))
    # a term has at most a place in each chunk
    known = words.groupBy(F.col("x.terms").alias("term")).agg(
        F.sum("x.dfs").cast("int").alias("df"), F.collect_list(F.struct("chunk", "pos")).alias("at")
    )
    # numbered before its places are rows, or each place would have another number
    numbered = known.filter("df > 1").select(F.monotonically_increasing_id().alias("tid"), "df", "at")
    back = numbered.select("tid", "df", F.inline("at")).groupBy("chunk").agg(F.collect_list(F.struct("pos", "tid", "df")).alias("v"))
    return _stored(chunks.drop("terms", "dfs").join(back.hint("merge"), "chunk", "left")), total


def _marked(placed: DataFrame, total: int) -> DataFrame:
    """Of every text ``id``, ``chunk``, its place ``at``, and marks that are equal for equal vectors only, but for the
    luck of two 64-bit hashes. A text with a term of its own (``n`` 0) equals no other."""
    kind = placed.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("id", kind)]).add("chunk", T.LongType()).add("at", T.IntegerType())
    for name in ("n", "x", "y"):
        out = out.add(name, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                at, tids, _, _, w, _ = _vectors(row, total)
                starts, n = at[:-1], np.diff(at)
                same = np.round(w, SAME).view(np.uint64)
                mark = _mix(_mix(tids.astype(np.uint64) * _GOLDEN) ^ same)
                x, y = (np.bitwise_xor.reduceat(m, starts).view(np.int64) for m in (mark, _mix(mark ^ _GOLDEN)))
                place, chunk = np.arange(len(n)), row["chunk"].as_py()
                own = np.minimum.reduceat(tids, starts) < 0
                n, x, y = np.where(own, 0, n), np.where(own, chunk, x), np.where(own, place, y)
                columns = [row["ids"].values, pa.array(np.full(len(n), chunk)), pa.array(place, pa.int32()), *(pa.array(c) for c in (n, x, y))]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return placed.mapInArrow(run, out)


def _blocks(placed: DataFrame, kept: DataFrame, total: int, parts: int) -> DataFrame:
    """The vectors of the texts at the places of ``kept`` (``chunk``, ``ats``), without terms of one id: per block their
    ``ids``, sizes and lengths, the sorted numbers and ``dfs`` of their terms, packed entries, and the heaviest terms."""
    kind = T.ArrayType(placed.schema["ids"].dataType.elementType)
    out = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", kind)]).add("terms", T.IntegerType())
    for name in ("sizes", "norms", "tids", "dfs", "codes", "tfs"):
        out = out.add(name, T.BinaryType())
    out = out.add("heavy", T.ArrayType(T.LongType())).add("mass", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                at, tids, tfs, dfs, w, norms = _vectors(row, total)
                places = np.sort(row["ats"].values.to_numpy())
                # entries of one id's terms come first in each text
                first = at[:-1] + np.add.reduceat(tids < 0, at[:-1])
                size = (at[1:] - first)[places]
                ends, lo, block = np.cumsum(size), 0, row["chunk"].as_py() << 12
                while lo < len(places):
                    hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _ENTRIES, side="right"))
                    hi = max(lo + 1, min(hi, lo + _DOCS))
                    some, sizes = places[lo:hi], size[lo:hi]
                    lo = hi
                    pick = np.repeat(first[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    known, index, codes = np.unique(tids[pick], return_index=True, return_inverse=True)
                    if not len(known):
                        continue  # these texts share no term with another
                    mass = np.bincount(codes, w[pick] ** 2)
                    most = np.argsort(-mass, kind="stable")[: _MANY[1]]
                    binary = (packed(sizes), norms[some].astype("<f8").tobytes(), packed(known, "<u8"), packed(dfs[pick][index]), packed(codes), packed(tfs[pick]))
                    lists = [row["ids"].values.take(pa.array(some)), pa.array(known[most]), pa.array(mass[most])]
                    ids, heavy, mass = (pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)
                    columns = [pa.array([block]), ids, pa.array([len(known)], pa.int32()), *(pa.array([b], pa.binary()) for b in binary), heavy, mass]
                    yield pa.RecordBatch.from_arrays(columns, names=out.names)
                    block += 1

    chosen = placed.join(kept.hint("merge"), "chunk")
    return _stored(chosen.mapInArrow(run, out).repartition(parts))


class _Block:
    """A block as its task has it: weights, lengths per group, and texts in an order that puts like ones together."""

    def __init__(self, row: dict, total: int, heavy: np.ndarray):
        self.ids = row["ids"].values
        n, v = len(self.ids), row["terms"].as_py()
        sizes = unpacked(row["sizes"].as_py(), n).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.codes, tfs = (unpacked(row[c].as_py(), int(self.at[-1])).astype(np.int64) for c in ("codes", "tfs"))
        self.tids = unpacked(row["tids"].as_py(), v, "<u8").view(np.int64)
        dfs = unpacked(row["dfs"].as_py(), v)
        of = np.repeat(np.arange(n), sizes)
        self.w = tfs * (np.log((total + 1) / (dfs + 1.0)) + 1)[self.codes] / np.frombuffer(row["norms"].as_py(), "<f8")[of]
        rank = np.full(v, _MANY[1])
        at = np.minimum(np.searchsorted(self.tids, heavy), v - 1)
        found = self.tids[at] == heavy
        rank[at[found]] = np.flatnonzero(found)
        hashed = _mix(self.tids.view(np.uint64) * _GOLDEN)
        self.lengths = []
        for groups, alone in (_FEW, _MANY):
            group = np.where(rank < alone, rank, alone + (hashed % np.uint64(groups - alone)).astype(np.int64))
            lengths = np.zeros((n, groups), np.float32)
            for lo in range(0, n, 1024):
                part = slice(self.at[lo], self.at[min(n, lo + 1024)])
                sums = np.bincount((of[part] - lo) * groups + group[self.codes[part]], self.w[part] ** 2, minlength=min(n - lo, 1024) * groups)
                lengths[lo : lo + 1024] = np.sqrt(sums).reshape(-1, groups)
            self.lengths.append(lengths)
        self.order = np.lexsort((sizes, self.lengths[0][:, : _FEW[1]].argmax(axis=1)))
        self.lengths = [x[self.order] for x in self.lengths]


def _close(a: _Block, b: _Block, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts of ``a`` and ``b`` whose product of lengths reaches ``least``."""
    xs, ys = [], []
    for i in range(0, len(a.order), _TILE):
        few = a.lengths[0][i : i + _TILE] @ b.lengths[0].T >= least
        for j in range(0, len(b.order), _TILE):
            part = few[:, j : j + _TILE]
            rows, columns = np.flatnonzero(part.any(axis=1)), np.flatnonzero(part.any(axis=0))
            if len(rows):
                x, y = np.nonzero(a.lengths[1][i + rows] @ b.lengths[1][j + columns].T >= least)
                xs.append(a.order[i + rows[x]])
                ys.append(b.order[j + columns[y]])
    if not xs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(xs), np.concatenate(ys)


def _dots(a: _Block, b: _Block, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Dot products of whole vectors; ``xs`` ascends."""
    known = np.append(a.tids, -1)
    to = np.searchsorted(a.tids, b.tids)
    there = np.where(known[to] == b.tids, to, len(a.tids))[b.codes]  # the last place is none
    dots = np.zeros(len(xs))
    row = np.zeros(len(a.tids) + 1)
    ends, each = b.at.tolist(), ys.tolist()
    starts = np.flatnonzero(np.r_[True, xs[1:] != xs[:-1]]) if len(xs) else np.zeros(0, np.int64)
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(xs)]):
        own = slice(a.at[xs[lo]], a.at[xs[lo] + 1])
        row[a.codes[own]] = a.w[own]
        for i in range(lo, hi):
            to, end = ends[each[i]], ends[each[i] + 1]
            dots[i] = row.take(there[to:end]).dot(b.w[to:end])
        row[a.codes[own]] = 0
    return dots


def _links(blocks: DataFrame, total: int, threshold: float) -> DataFrame:
    """``a``, ``b`` (``a < b``), ``cosine`` of every pair of texts of ``blocks`` that reaches ``threshold``."""
    mass = blocks.select(F.explode(F.arrays_zip("heavy", "mass")).alias("x")).groupBy("x.heavy").agg(F.sum("x.mass").alias("mass"))
    heavy = np.array([r[0] for r in mass.orderBy(F.desc("mass"), "heavy").limit(_MANY[1]).collect()], np.int64)
    blocks = blocks.drop("heavy", "mass")
    names = blocks.columns
    other = blocks.select(*(F.col(c).alias(f"b_{c}") for c in names))
    met = blocks.join(other.hint("shuffle_replicate_nl"), F.col("block") <= F.col("b_block"))
    kind = blocks.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("x", kind), T.StructField("y", kind), T.StructField("dot", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [{c: batch.column(p + c)[i] for c in names} for p in ("", "b_")]
                left, right = (r["block"].as_py() for r in rows)
                if held[0] != left:
                    held = (left, _Block(rows[0], total, heavy))
                a = held[1]
                b = a if right == left else _Block(rows[1], total, heavy)
                xs, ys = _close(a, b, threshold - _MISS)
                if a is b:
                    xs, ys = xs[xs < ys], ys[xs < ys]
                order = np.argsort(xs, kind="stable")
                xs, ys = xs[order], ys[order]
                dots = _dots(a, b, xs, ys)
                near = np.flatnonzero(dots >= threshold - 10.0**-DIGITS)
                for lo in range(0, len(near), 1 << 16):
                    some = near[lo : lo + (1 << 16)]
                    columns = [a.ids.take(pa.array(xs[some])), b.ids.take(pa.array(ys[some])), pa.array(dots[some])]
                    yield pa.RecordBatch.from_arrays(columns, names=out.names)

    found = met.mapInArrow(run, out).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.round("dot", DIGITS).alias("cosine"))
    return _stored(found.filter(F.col("cosine") >= threshold))


def similar_classes(df: DataFrame, id: str, text: str, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """What :func:`similarity.similar_classes` gives for the TF-IDF vectors of the texts of ``df``, texts of a repeated
    ``id`` taken together: ``id``, ``rep``, and ``a``, ``b``, ``cosine`` of representatives."""
    placed, total = _placed(df, id, text)
    members = _stored(classes_of(_marked(placed, total), "chunk", "at"))
    reps = members.filter(F.col("id") == F.col("rep"))
    kept = reps.groupBy("chunk").agg(F.collect_list("at").alias("ats"))
    count = reps.count()
    blocks = _blocks(placed, kept, total, max(1, min(_PARTS, ceil(2 * count / _DOCS))))
    return members.select("id", "rep"), _links(blocks, total, threshold)
