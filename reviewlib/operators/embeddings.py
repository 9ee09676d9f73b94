"""Word and text embeddings learned from the corpus itself: positive PMI and block power iteration.

Words of a text (the vocabulary's rule, the ``num_words`` most frequent) co-occur when at most
``window`` positions apart. A text is cut into words once and kept as word ids; a task counts the pairs of a batch of texts, so what is
shuffled are counted pairs of known words, not places. Texts that share an id are
one text of several words a place; only those are joined by (text, place), one equi-join per distance. Positive pointwise mutual information ``max(0, ln(c_ij * N /
(c_i * c_j)))`` makes a sparse symmetric matrix, held as rows (``i``, ``j``, ``m``).

Its leading eigenvectors come from block power iteration: the block ``Q`` (words x ``k``) is
multiplied by the sparse matrix with a join and a sum per word, then made orthonormal by Cholesky
QR: the ``k x k`` Gram matrix is added up in Spark, factored on the driver, and its inverse factor
goes back to the tasks. Only ``k x k`` matrices reach the driver, one per task; numpy does the
small products in the tasks. After the iterations, a
Rayleigh-Ritz step (``Q^T M Q``, again ``k x k``) gives the eigenvalues, whose absolute values are
the singular values; a word's embedding is its row of the rotated block times the square root of
the singular values, and a text's the mean of its words'.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.operators.vocabulary import tokens
from reviewlib.scratch import scratch_dir


@dataclass(frozen=True)
class EmbeddingConfig:
    num_words: int = 5_000
    window: int = 2
    k: int = 16
    iterations: int = 20
    # extra columns carried through the iteration, so the k wanted converge faster
    oversample: int = 8
    seed: int = 7


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ppmi(df: DataFrame, id: str, text: str, cfg: EmbeddingConfig = EmbeddingConfig()) -> tuple[DataFrame, DataFrame]:
    """The words kept (``token``, ``i``) and the positive PMI matrix (``i``, ``j``, ``m``)."""
    texts = _stored(df.filter(F.col(id).isNotNull()).select(F.col(id).alias("doc"), tokens(text).alias("words")))
    counts = texts.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    words = counts.orderBy(F.desc("n"), "token").limit(cfg.num_words)
    # at most num_words rows reach this window
    words = _stored(words.select("token", F.row_number().over(Window.orderBy(F.desc("n"), "token")).alias("i")))
    again = _stored(texts.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").select("doc"))
    pairs = _near(texts.join(again, "doc", "left_anti"), words, cfg.window)
    known = texts.join(again, "doc", "left_semi").select("doc", F.posexplode("words").alias("pos", "token"))
    known = _stored(known.join(F.broadcast(words), "token").select("doc", "pos", "i"))
    after = known.select("doc", F.col("pos").alias("p2"), F.col("i").alias("j"))
    for d in range(1, cfg.window + 1):
        near = known.join(after, (known["doc"] == after["doc"]) & (after["p2"] == known["pos"] + d))
        pairs = pairs.unionByName(near.select("i", "j", F.lit(1).cast("long").alias("c")))
    both = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "c"))
    co = _stored(both.groupBy("i", "j").agg(F.sum("c").cast("double").alias("c")))
    marg = co.groupBy("i").agg(F.sum("c").alias("ci"))
    total = co.agg(F.sum("c")).first()[0] or 0.0
    m = (
        co.join(marg, "i")
        .join(marg.select(F.col("i").alias("j"), F.col("ci").alias("cj")), "j")
        .select("i", "j", F.log(F.col("c") * F.lit(total) / (F.col("ci") * F.col("cj"))).alias("m"))
        .filter(F.col("m") > 0)
    )
    return words, _stored(m)


def _near(texts: DataFrame, words: DataFrame, window: int) -> DataFrame:
    """``i``, ``j``, ``c``: how often word ``j`` comes at most ``window`` places after word ``i`` in
    ``texts`` (``words``: array), counted in parts. ``words`` has at most ``num_words`` rows."""
    rows = words.select("token", "i").collect()
    table, ids = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            column = batch.column(0)
            flat = ids.take(pc.index_in(column.flatten(), value_set=table)).fill_null(0).to_numpy()
            of = np.repeat(np.arange(len(column)), pc.list_value_length(column).fill_null(0).to_numpy())
            found = []
            for d in range(1, window + 1):
                met = (flat[d:] > 0) & (flat[:-d] > 0) & (of[d:] == of[:-d])
                found.append(flat[:-d][met] << 32 | flat[d:][met])
            codes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes >> 32), pa.array(codes & 0xFFFFFFFF), pa.array(n.astype(np.int64))], names=["i", "j", "c"]
            )

    found = texts.select("words").mapInArrow(run, "i long, j long, c long")
    return found.groupBy(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j")).agg(F.sum("c").alias("c"))


def _block(spark, rows: np.ndarray, ids: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows)], "i long, q array<double>")


def _times(matrix: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """``matrix @ block``: (``i``, ``q``) rows."""
    joined = matrix.join(block.withColumnRenamed("i", "j"), "j")
    sums = joined.groupBy("i").agg(*(F.sum(F.col("m") * F.col("q")[c]).alias(f"s{c}") for c in range(k)))
    return sums.select("i", F.array(*(F.col(f"s{c}") for c in range(k))).alias("q"))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    q = batch.column("q")
    width = len(q[0]) if len(q) else 0
    return q.values.to_numpy(zero_copy_only=False).reshape(-1, width) if len(q) else np.zeros((0, 0))


def _gram(block: DataFrame, k: int) -> np.ndarray:
    """``block^T block``: each task adds up its rows' outer products in numpy; one ``k x k``
    matrix per task reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((k, k))
        for batch in batches:
            rows = _rows(batch)
            if len(rows):
                g += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([g.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])

    parts = block.select("q").mapInArrow(run, "g array<double>").collect()  # one row per task
    return sum((np.array(r["g"]).reshape(k, k) for r in parts), np.zeros((k, k)))


def _apply(block: DataFrame, r: np.ndarray, k: int) -> DataFrame:
    """``block @ r``, with the small ``r`` given to every task."""
    r = np.asarray(r, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch)
            out = rows @ r if len(rows) else np.zeros((0, r.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(list(out), pa.list_(pa.float64()))], names=["i", "q"]
            )

    return block.select(F.col("i").cast("long").alias("i"), "q").mapInArrow(run, "i long, q array<double>")


def _cross(rows: DataFrame, k: int) -> np.ndarray:
    """``q^T mq`` over rows with both blocks, added up per task in numpy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = np.zeros((k, k))
        for batch in batches:
            q = batch.column("q").values.to_numpy(zero_copy_only=False).reshape(-1, k)
            mq = batch.column("mq").values.to_numpy(zero_copy_only=False).reshape(-1, k)
            t += q.T @ mq
        yield pa.RecordBatch.from_arrays([pa.array([t.ravel().tolist()], pa.list_(pa.float64()))], names=["t"])

    parts = rows.select("q", "mq").mapInArrow(run, "t array<double>").collect()  # one row per task
    return sum((np.array(r["t"]).reshape(k, k) for r in parts), np.zeros((k, k)))


def top_eigen(matrix: DataFrame, n: int, cfg: EmbeddingConfig = EmbeddingConfig()) -> tuple[np.ndarray, DataFrame]:
    """The ``k`` leading eigenvalues (largest magnitude first) of the symmetric ``matrix`` (``i``,
    ``j``, ``m``; ids 1..n) and the block of their eigenvectors (``i``, ``q``)."""
    spark = matrix.sparkSession
    k = min(cfg.k + cfg.oversample, n)
    draw = np.random.default_rng(cfg.seed)
    block = _stored(_block(spark, draw.normal(size=(n, k)), np.arange(1, n + 1)))
    for _ in range(cfg.iterations):
        y = _stored(_times(matrix, block, k))
        g = _gram(y, k) + 1e-12 * np.eye(k)
        inverse = np.linalg.inv(np.linalg.cholesky(g).T)
        block = _apply(y, inverse, k)  # read from the stored product, so plans stay one step deep
    block = _stored(block)
    product = _times(matrix, block, k).withColumnRenamed("q", "mq").join(block, "i")
    t = _cross(product, k)
    values, vectors = np.linalg.eigh((t + t.T) / 2)
    order = np.argsort(-np.abs(values))[: min(cfg.k, n)]
    return values[order], _stored(_apply(block, vectors[:, order], k))


def word_vectors(df: DataFrame, id: str, text: str, cfg: EmbeddingConfig = EmbeddingConfig()) -> tuple[np.ndarray, DataFrame]:
    """Singular values, and ``token``, ``vector`` of each kept word."""
    words, m = ppmi(df, id, text, cfg)
    n = words.count()
    if n == 0:
        return np.zeros(0), words.select("token", F.array().cast("array<double>").alias("vector"))
    values, block = top_eigen(m, n, cfg)
    scale = np.sqrt(np.abs(values))
    # a word with no positive PMI to any other has the zero vector
    vec = F.array(*(F.coalesce(F.col("q")[c], F.lit(0.0)) * float(scale[c]) for c in range(len(scale))))
    return np.abs(values), words.join(block, "i", "left").select("token", vec.alias("vector"))
