"""Topic labels by non-negative matrix factorisation with multiplicative updates.

The matrix is rows (``d``, ``t``, ``v``): documents by words of a capped vocabulary. It is
approximated by ``W`` (``k`` weights per document, kept in Spark) times ``H`` (``k``
weights per word, at most ``num_words x k`` numbers, on the driver). One round updates ``H`` from
``W^T V`` and ``W^T W`` (``k x k``), then ``W`` from ``V H^T`` and ``H H^T``, document by document. A row is a packed block
of documents with their words, counts and weights, so no round joins or shuffles the matrix. One pass a round updates the
weights of a block and adds up what the next ``H`` needs of them; a task writes its blocks and one row of its sums to the
scratch folder, and only these sums move. The squared error comes with them, from ``||V||^2 - 2 tr(W^T V H^T) + tr(W^T W H H^T)``;
multiplicative updates never raise it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.operators.similar_texts import chunks_of, packed, unpacked
from reviewlib.scratch import scratch_dir

_TINY = 1e-12
# Documents of a block at most.
_DOCS = 4096
# A block; or, with null ids, the sums of a task's blocks.
_STATE = "ds array<bigint>, n int, sizes binary, ts binary, vs binary, w binary, sums array<double>"


@dataclass(frozen=True)
class TopicConfig:
    k: int = 8
    num_words: int = 2_000
    rounds: int = 30
    seed: int = 5


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def start_w(d: np.ndarray, k: int) -> np.ndarray:
    """Starting weights of documents, a fixed function of their ids (so numpy can repeat it)."""
    j = np.arange(k)
    return 0.5 + ((d[:, None] * 7919 + j[None, :] * 104729) % 1000) / 2000.0


def _sums_row(sums: np.ndarray) -> pa.RecordBatch:
    row = [None, None, None, None, None, None, sums.tolist()]
    kinds = (pa.list_(pa.int64()), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names=_names())


def _names() -> list[str]:
    return [column.split()[0] for column in _STATE.split(", ")]


def _pass(sums: np.ndarray, w: np.ndarray, ts: np.ndarray, vs: np.ndarray, sizes: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
    """The weights ``w`` of a block, updated if there is ``h``; adds up their ``V^T W``, ``W^T W`` and, last, ``||V||^2``.
    Some documents at a time are a dense matrix of about a million cells."""
    k = w.shape[1]
    words = (len(sums) - 1) // k - k
    products, out = sums[:-1].reshape(-1, k), []
    ends = np.concatenate([[0], np.cumsum(sizes)])
    step = max(1, (1 << 20) // max(1, words))
    for lo in range(0, len(sizes), step):
        some, x = sizes[lo : lo + step], w[lo : lo + step]
        part = slice(ends[lo], ends[min(len(sizes), lo + step)])
        of = np.repeat(np.arange(len(some)) * words, some)
        v = np.bincount(of + ts[part], vs[part], minlength=len(some) * words).reshape(len(some), words)
        if h is not None:
            x = x * (v @ h.T) / (x @ (h @ h.T) + _TINY)
        products[:words] += v.T @ x
        products[words:] += x.T @ x
        out.append(x)
    sums[-1] += vs @ vs
    return np.concatenate(out) if out else w


def _blocks(rows: DataFrame, k: int, words: int) -> DataFrame:
    """Rows of documents (``d``, ``ts``, ``vs``, and ``w`` if they have weights yet) as blocks, with the sums of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((words + k) * k + 1)
        for whole in batches:
            for lo in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(lo, _DOCS)
                d = batch.column("d")
                sizes = pc.list_value_length(batch.column("ts")).to_numpy(zero_copy_only=False).astype(np.int64)
                ts, vs = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ts", "vs"))
                if "w" in batch.schema.names:
                    w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                else:
                    w = start_w(d.to_numpy(zero_copy_only=False), k)
                _pass(sums, w, ts.astype(np.int64), vs, sizes)
                ids = pa.ListArray.from_arrays(pa.array([0, len(d)], pa.int32()), d)
                binary = (packed(sizes), packed(ts), packed(vs, "<f8"), w.astype("<f8").tobytes())
                columns = [ids, pa.array([int(sizes.sum())], pa.int32()), *(pa.array([b], pa.binary()) for b in binary), pa.array([None], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=_names())
        yield _sums_row(sums)

    return rows.mapInArrow(run, _STATE)


def _updated(state: DataFrame, h: np.ndarray) -> DataFrame:
    """The blocks with ``W`` updated from ``V H^T`` and ``H H^T``, and the sums of each task."""
    k, words = h.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((words + k) * k + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in _names()}
                n, docs = row["n"].as_py(), len(row["ds"].values)
                sizes, ts = unpacked(row["sizes"].as_py(), docs).astype(np.int64), unpacked(row["ts"].as_py(), n).astype(np.int64)
                w = np.frombuffer(row["w"].as_py(), "<f8").reshape(-1, k)
                new = _pass(sums, w, ts, unpacked(row["vs"].as_py(), n, "<f8"), sizes, h)
                at = _names().index("w")
                columns = [c.slice(i, 1) for c in batch.columns]
                columns[at] = pa.array([new.astype("<f8").tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=_names())
        yield _sums_row(sums)

    return state.filter("ds IS NOT NULL").mapInArrow(run, _STATE)


def _summed(state: DataFrame, k: int, words: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``W^T V`` (``k x words``), ``W^T W`` and ``||V||^2`` of blocks."""
    parts = state.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).toArrow()  # capped vocabulary
    sums = np.zeros((words + k) * k + 1)
    sums[parts["i"].to_numpy()] = parts["s"].to_numpy()
    products = sums[:-1].reshape(-1, k)
    return products[:words].T, products[words:], float(sums[-1])


def _products(state: DataFrame, k: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``W^T V`` and ``W^T W`` of rows of documents with their weights."""
    return _summed(_blocks(state, k, words), k, words)[:2]


def factorise(matrix: DataFrame, words: int, cfg: TopicConfig = TopicConfig()) -> tuple[DataFrame, np.ndarray, list[float]]:
    """``W`` (``d``, ``w``: array of ``k``), ``H`` (``k x words``; words numbered 0..words-1 in
    ``t``) and the squared error before each round and after the last. ``matrix`` is entries (``d``, ``t``, ``v``), or
    documents with their words and values (``d``, ``ts``, ``vs``)."""
    k = cfg.k
    if "ts" not in matrix.columns:
        entries = matrix.select(F.col("d").cast("long"), F.col("t").cast("int"), F.col("v").cast("double"))
        # at most words entries a document
        lists = entries.groupBy("d", "t").agg(F.sum("v").alias("v")).groupBy("d").agg(F.collect_list(F.struct("t", "v")).alias("x"))
        matrix = lists.select("d", F.col("x.t").alias("ts"), F.col("x.v").alias("vs"))
    state = _stored(_blocks(matrix.filter("d IS NOT NULL"), k, words))
    h = np.random.default_rng(cfg.seed).uniform(0.5, 1.0, (k, words))
    losses = []
    for _ in range(cfg.rounds + 1):
        # H from W^T V and W^T W
        numer, wtw, norm = _summed(state, k, words)
        loss = norm - 2 * float((numer * h).sum()) + float(np.trace(wtw @ (h @ h.T)))
        losses.append(loss)
        if len(losses) > cfg.rounds:
            break
        h = h * numer / (wtw @ h + _TINY)
        state = _stored(_updated(state, h))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, w = batch.column(0)[i].values, pa.array(np.frombuffer(batch.column(1)[i].as_py(), "<f8"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * k), w)
                yield pa.RecordBatch.from_arrays([ids, lists], names=["d", "w"])

    w = state.filter("ds IS NOT NULL").select("ds", "w").mapInArrow(rows, "d long, w array<double>")
    return w, h, losses


def term_matrix(df: DataFrame, id: str, text: str, num_words: int) -> tuple[DataFrame, DataFrame]:
    """Words (``token``, ``t`` from 0) of the ``num_words`` most frequent, and per text with an id and any of them these
    (``d``, ``ts``) and their counts (``vs``). Texts are cut into words once."""
    chunks = chunks_of(df.filter(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("d"), text), "d", text)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, sizes, codes, tfs in zip(*(batch.column(c) for c in ("terms", "sizes", "codes", "tfs"))):
                n = int(sizes.values.to_numpy().sum())
                codes, tfs = unpacked(codes.as_py(), n), unpacked(tfs.as_py(), n)
                yield pa.RecordBatch.from_arrays([terms.values, pa.array(np.bincount(codes, tfs).astype(np.int64))], names=["token", "n"])

    counts = chunks.mapInArrow(occurrences, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # at most num_words rows reach this window
    top = counts.orderBy(F.desc("n"), "token").limit(num_words)
    words = _stored(top.select("token", (F.row_number().over(Window.orderBy(F.desc("n"), "token")) - 1).alias("t")))
    known = words.collect()  # at most num_words rows
    table, numbers = [r["token"] for r in known], np.array([r["t"] for r in known] + [-1])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, terms, sizes, codes, tfs in zip(*(batch.column(c) for c in ("ids", "terms", "sizes", "codes", "tfs"))):
                sizes = sizes.values.to_numpy()
                n = int(sizes.sum())
                codes, tfs = unpacked(codes.as_py(), n), unpacked(tfs.as_py(), n)
                at = pc.index_in(terms.values, value_set=pa.array(table, pa.string())).fill_null(len(table)).to_numpy()
                ts = numbers[at][codes]
                of = np.repeat(np.arange(len(sizes)), sizes)[ts >= 0]
                docs, many = np.unique(of, return_counts=True)
                ends = pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32())
                lists = (pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ts[ts >= 0].astype(np.int32), tfs[ts >= 0].astype(np.float64)))
                yield pa.RecordBatch.from_arrays([ids.values.take(pa.array(docs)), *lists], names=["d", "ts", "vs"])

    return words, chunks.mapInArrow(kept, "d long, ts array<int>, vs array<double>")
