"""Quality of documents: random-indexing word vectors, pooled, into a small network.

Every labelled document counts at every step of learning: words, contexts, scaling, network and temperature. The network
is trained in shards of bounded size, which tasks carry on for some epochs from the same weights; the weights, and
the optimiser's running means, are then averaged by rows. The driver sees sums only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.llm.common import bitmap, map_texts, maybe_in, quoted, stored
from reviewlib.llm.words import Coder, mix

# Parameters that bound the model: words whose contexts are learned, and the vectors' size.
WORDS = 20_000
SIZE = 32
NEIGHBOURS = 2
# Non-zero entries of a word's index vector.
_SPARSE = 4
_INDEX = 1 << 14
# Pooled vectors of short texts are drawn to the mean as if by so many more words.
_PRIOR = 8
HIDDEN = 32
EPOCHS = 60
BATCH = 128
# Labelled documents, about, on which one place trains, and epochs between two averages.
SHARD = 8_000
ROUND = 5
CALIBRATE = 0.2  # share of the labelled documents that sets the temperature
THRESHOLD = 0.3


@dataclass
class Model:
    """Word vectors sorted by word code, and the network over pooled vectors."""

    codes: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float


def index_table() -> np.ndarray:
    """Fixed sparse random vectors of length 1: a few entries of one size, up or down."""
    draw = np.random.default_rng(3)
    out = np.zeros((_INDEX, SIZE), np.float32)
    for row in out:
        row[draw.choice(SIZE, _SPARSE, replace=False)] = draw.choice([-1, 1], _SPARSE)
    return out / np.float32(_SPARSE**0.5)


def _indexed(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The index vector of each word code."""
    return table[(codes % np.uint64(_INDEX)).astype(np.int64)]


# First and last characters of a word are of so many kinds, and its length counts up to 8.
_KINDS = 127
_SHAPES = _KINDS * _KINDS * 9


def _shapes(group) -> np.ndarray:
    """What each word looks like, as a number: kind of its first and last character, length."""
    kind = np.zeros(256, np.int32)
    kind[33:128] = np.arange(33, 128) - 1  # punctuation stands for itself
    kind[48:58], kind[65:91], kind[97:123], kind[128:] = 1, 2, 3, 4
    length = np.minimum(group.ends - group.starts, 8).astype(np.int32)
    return (kind[group.data[group.starts]] * _KINDS + kind[group.data[group.ends - 1]]) * 9 + length


def _shape_codes(shapes: np.ndarray) -> np.ndarray:
    return mix(shapes.astype(np.uint64) + np.uint64(1 << 40))


def _known(codes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word among the ascending ``codes``, and whether it is there."""
    at = np.minimum(np.searchsorted(codes, words), max(0, len(codes) - 1))
    return at, (codes[at] == words if len(codes) else np.zeros(len(words), bool))


def _word_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(lower=False, split=True)
        for batch in batches:
            for group in coder.groups(batch.column(0)):
                codes, n = np.unique(
                    np.concatenate([group.codes, _shape_codes(_shapes(group))]), return_counts=True
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"]
                )

    return texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _contexts(texts: DataFrame, codes: np.ndarray) -> DataFrame:
    """``row`` of a word in ``codes`` and the sum of the index vectors of the words near it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = Coder(lower=False, split=True), index_table()
        total, met = np.zeros((len(codes), SIZE)), np.zeros(len(codes), bool)
        for batch in batches:
            for group in coder.groups(batch.column(0)):
                shapes = _shape_codes(_shapes(group))
                texts_of = np.repeat(np.arange(group.hi - group.lo), np.diff(group.bounds))
                index = _indexed(table, group.codes) + _indexed(table, shapes)
                near = np.zeros_like(index)
                for k in range(1, NEIGHBOURS + 1):
                    same = (texts_of[k:] == texts_of[:-k])[:, None]
                    near[k:] += index[:-k] * same
                    near[:-k] += index[k:] * same
                # a word's own index vector keeps apart words that share their neighbours
                near += index
                at, there = _known(codes, np.concatenate([group.codes, shapes]))
                if not there.any():
                    continue
                order = np.argsort(at[there], kind="stable")
                rows, first = np.unique(at[there][order], return_index=True)
                near = np.concatenate([near, near])[there][order]
                total[rows] += np.add.reduceat(near, first, axis=0, dtype=np.float64)
                met[rows] = True
        rows = np.flatnonzero(met)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[rows].ravel()), SIZE)
        yield pa.RecordBatch.from_arrays([pa.array(rows), sums.cast(pa.list_(pa.float64()))], names=["row", "sums"])

    parts = texts.mapInArrow(run, "row long, sums array<double>")
    return parts.groupBy("row").agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SIZE)))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9).astype(np.float32)


class Pooler:
    """Pooled word vectors of texts; one per task.

    A word whose contexts were not learned has its index vector.
    """

    def __init__(self, codes: np.ndarray, vectors: np.ndarray):
        self.codes = codes
        self.index = index_table()
        self.vectors = np.concatenate([vectors.astype(np.float32), self.index])
        self.coder = Coder(lower=False, split=True)
        self.shape_row = np.full(_SHAPES, -1, np.int64)

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        at, there = _known(self.codes, codes)
        return np.where(there, at, len(self.codes) + (codes % np.uint64(_INDEX)).astype(np.int64))

    def _rows_of_shapes(self, shapes: np.ndarray) -> np.ndarray:
        rows = self.shape_row[shapes]
        if (rows < 0).any():
            new = np.unique(shapes[rows < 0])
            self.shape_row[new] = self._rows(_shape_codes(new))
            rows = self.shape_row[shapes]
        return rows

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Per text the mean vector of its words and of their shapes, how alike the index vectors of
        two of its words are, and the number of words; zeros for a text without words."""
        out = np.zeros((len(texts), SIZE + 2), np.float64)
        for group in self.coder.groups(texts):
            count = np.diff(group.bounds)
            some = np.flatnonzero(count)
            if not len(some):
                continue
            rows, n, first = group.lo + some, count[some], group.bounds[:-1][some]
            vectors = self.vectors[self._rows(group.codes)]
            vectors += self.vectors[self._rows_of_shapes(_shapes(group))]
            out[rows, :SIZE] = np.add.reduceat(vectors, first, axis=0) / n[:, None]
            # index vectors have length 1 and different ones are unlike, so this is about the share
            # of pairs of words that are the same
            same = np.add.reduceat(_indexed(self.index, group.codes), first, axis=0)
            alike = ((same.astype(np.float64) ** 2).sum(1) - n) / np.maximum(n * (n - 1.0), 1)
            out[rows, SIZE] = np.where(n > 1, alike, 0)
            out[rows, SIZE + 1] = n
        return out


def _features(pooled: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    n = pooled[:, SIZE + 1 :]
    return np.hstack([(pooled[:, : SIZE + 1] - mean) / spread * (n / (n + _PRIOR)), np.log1p(n) / 5])


def _logit(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _start(width: int) -> list[np.ndarray]:
    draw = np.random.default_rng(1)
    return [
        draw.normal(0, (2 / width) ** 0.5, (width, HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
        np.zeros(()),
    ]


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def _shaped(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([p.size for p in like])
    return [flat[e - p.size : e].reshape(p.shape).copy() for e, p in zip(ends, like)]


def _epochs(state: np.ndarray, x: np.ndarray, y: np.ndarray, begin: int, end: int) -> np.ndarray:
    """``state`` (layers, first and second running means, one after the other) after the epochs from ``begin``
    to ``end`` of Adam on the cross-entropy."""
    like = _start(x.shape[1])
    layers, first, second = (_shaped(part, like) for part in np.split(state, 3))
    step = begin * -(-len(x) // BATCH)
    draw = np.random.default_rng(1)
    draw.normal(size=like[0].size + like[2].size)  # the draws of the start, then those of earlier epochs
    for _ in range(begin):
        draw.permutation(len(x))
    for epoch in range(begin, end):
        order = draw.permutation(len(x))
        for at in range(0, len(x), BATCH):
            some, known = x[order[at : at + BATCH]], y[order[at : at + BATCH]]
            step += 1
            hidden = np.maximum(some @ layers[0] + layers[1], 0)
            error = (_sigmoid(hidden @ layers[2] + layers[3]) - known) / len(known)
            back = np.outer(error, layers[2]) * (hidden > 0)
            slopes = [some.T @ back, back.sum(0), hidden.T @ error, error.sum()]
            rate = 0.005 * (1 - epoch / EPOCHS)
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                move = first[i] / (1 - 0.9**step)
                layers[i] = layers[i] - rate * move / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return _flat([*layers, *first, *second])


def _shards(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``y``, ``x``) dealt by hash into shards of about ``SHARD``, a row for each: ``x``, ``y``
    and ``held`` (whether a document is kept for the temperature), packed, in an order of their own."""
    shards = max(1, -(-rows.count() // SHARD))
    # equal ids may repeat, so their vectors deal them too
    dealt = rows.select("doc_id", "y", "x", F.pmod(F.xxhash64("doc_id", "x"), F.lit(shards)).alias("shard"))

    def run(table: pa.Table) -> pa.Table:
        x = table["x"].combine_chunks().flatten().to_numpy().reshape(-1, SIZE + 2)
        y = table["y"].to_numpy().astype(np.float64)
        order = np.lexsort((*x.T[::-1], y, table["doc_id"].to_numpy()))
        packed = x[order], y[order], np.random.default_rng(2).random(len(x)) < CALIBRATE
        return pa.table({name: pa.array([part.tobytes()], pa.binary()) for name, part in zip(("x", "y", "held"), packed)})

    return stored(dealt.groupBy("shard").applyInArrow(run, "x binary, y binary, held binary"))


def _added(shards: DataFrame, size: int, function: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum over all shards of ``function(x, y, held)``, an array of ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x, y, held in zip(*(column.to_pylist() for column in batch.columns)):
                total += function(np.frombuffer(x).reshape(-1, SIZE + 2), np.frombuffer(y), np.frombuffer(held, bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

    parts = shards.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[parts["at"].to_numpy()] = parts["value"].to_numpy()
    return out


def _scales(shards: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of the pooled vectors."""
    wide = SIZE + 1
    found = _added(shards, wide + 1, lambda x, y, held: np.append(x[:, :wide].sum(0), len(x)))
    n = found[-1]
    if not n:
        return np.zeros(wide), np.ones(wide)
    mean = found[:-1] / n
    return mean, (_added(shards, wide, lambda x, y, held: ((x[:, :wide] - mean) ** 2).sum(0)) / n) ** 0.5 + 1e-3


def _train(shards: DataFrame, mean: np.ndarray, spread: np.ndarray) -> list[np.ndarray]:
    """Two layers fitted on all that is not held. Shards train side by side and are averaged every ``ROUND`` epochs."""
    like = _start(SIZE + 2)
    state = _flat([*like, *(np.zeros_like(p) for p in like + like)])
    for begin in range(0, EPOCHS, ROUND):

        def carried(x, y, held, begin=begin, state=state):
            n = len(x) - int(held.sum())
            if not n:
                return np.zeros(len(state) + 1)
            after = _epochs(state, _features(x[~held], mean, spread), y[~held], begin, min(EPOCHS, begin + ROUND))
            return np.append(n * after, n)

        found = _added(shards, len(state) + 1, carried)
        if not found[-1]:
            break
        state = found[:-1] / found[-1]
    return _shaped(state[: len(state) // 3], like)


def _temperature(shards: DataFrame, layers: list[np.ndarray], mean: np.ndarray, spread: np.ndarray) -> float:
    """What logits are divided by so that probabilities fit the held labels best."""
    tried = np.exp(np.linspace(np.log(0.2), np.log(20), 200))

    def loss(x, y, held):
        z = _logit(layers, _features(x[held], mean, spread))
        sure = np.where(y[held] == 1, z, -z)
        return np.append([np.logaddexp(0, -sure / t).sum() for t in tried], held.sum())

    found = _added(shards, len(tried) + 1, loss)
    return float(tried[int(np.argmin(found[:-1]))]) if found[-1] else 1.0


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``y``, ``t``: the texts of ``docs`` with each of their labels. A bitmap of ids lets few other
    texts into the join, which is exact."""
    marked = labels.select(
        quoted("doc_id").cast("long").alias("doc_id"), quoted("quality").cast("int").alias("y")
    ).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    marked = stored(marked.distinct())
    texts = docs.select(
        quoted("doc_id").cast("long").alias("doc_id"), quoted("text").cast("string").alias("t")
    ).filter("t IS NOT NULL AND doc_id IS NOT NULL")
    bits = bitmap(marked, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bits, batch.column(0).to_numpy())))

    # a merge join at every size: labels grow with the documents, so they are not broadcast
    return stored(texts.mapInArrow(run, texts.schema).join(marked.hint("merge"), "doc_id").select("doc_id", "y", "t"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from all rows of ``labels`` (``doc_id``, ``quality``) whose text ``docs`` has. Their words are
    counted, given vectors and pooled by tasks, which also train the network; the driver sees
    the counts and sums of at most ``WORDS`` words, and sums over the documents."""
    rows = _labelled(docs, labels)
    counts = _word_counts(rows.select("t")).orderBy(F.desc("n"), "code").limit(WORDS)
    codes = np.sort(np.array([r[0] for r in counts.select("code").collect()], np.int64).view(np.uint64))
    vectors = np.zeros((len(codes), SIZE), np.float32)
    for row, *sums in _contexts(rows.select("t"), codes).toLocalIterator():
        vectors[row] = sums
    # what all words have in common tells nothing
    vectors = _unit(vectors)
    vectors = _unit(vectors - vectors.mean(0, keepdims=True)) if len(vectors) else vectors
    pooled = map_texts(
        rows, "t", T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), _pool(codes, vectors)
    )
    shards = _shards(stored(pooled.select("doc_id", "y", "x")))
    mean, spread = _scales(shards)
    layers = _train(shards, mean, spread)
    return Model(codes, vectors, mean, spread, layers, _temperature(shards, layers, mean, spread))


def _pool(codes: np.ndarray, vectors: np.ndarray):
    def make():
        pooler = Pooler(codes, vectors)

        def run(texts: pa.Array) -> list[pa.Array]:
            found = pooler(texts)
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            return [pa.ListArray.from_arrays(ends, pa.array(found.ravel()))]

        return run

    return make


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out``, the probability of label 1. Only the text counts. A null text counts as
    empty; texts without words get the score of a zero vector. No shuffle."""

    def make():
        pooler = Pooler(model.codes, model.vectors)

        def run(texts: pa.Array) -> list[pa.Array]:
            x = _features(pooler(texts), model.mean, model.spread)
            return [pa.array(_sigmoid(_logit(model.layers, x) / model.temperature), pa.float64())]

        return run

    return map_texts(docs, text, T.StructType([T.StructField(out, T.DoubleType())]), make)
