"""A recurrent sequence classifier over word ids, trained data-parallel on Spark.

The model reads the id sequences of :func:`vocabulary.encode_sequences`: an embedding of each id,
a recurrent layer (``tanh``, the state kept across pads, id 0), the largest value of each unit
over the words of the text (zero for a text without words), and a softmax over the labels. The loss is class-weighted cross entropy, averaged over rows.

Training is iterative and data-parallel. Rows are written once to the scratch folder with a
step number (a hash of their id), partitioned by it, so each optimiser step reads the files of one
step. In a step every task computes, in numpy, the loss and gradient of its rows summed; gradients
leave a task as rows of ``WIDTH`` numbers keyed by parameter row, only rows of the embedding that
its texts touch, and are added by a Spark aggregate (partial sums per task first), so only one
gradient, the size of the weights, reaches the driver, which applies Adam. After each epoch (all
steps) the validation loss is summed the same way; training stops when it has not improved for
``patience`` epochs, and the best weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.functions.patterns import LABELS

# Rows of a task that one numpy pass takes at most.
_BATCH = 256


@dataclass(frozen=True)
class SequenceConfig:
    """Model size and training settings."""

    num_words: int = 20_000
    embed: int = 16
    hidden: int = 16
    epochs: int = 20
    patience: int = 3
    steps: int = 8
    learning_rate: float = 0.03
    seed: int = 42


@dataclass
class SequenceModel:
    """Weights (by name) and the validation loss of every epoch trained."""

    weights: dict[str, np.ndarray]
    history: list[float] = field(default_factory=list)
    best_epoch: int = 0

    @property
    def epochs_trained(self) -> int:
        return len(self.history)


def initial_weights(cfg: SequenceConfig, classes: int = len(LABELS)) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(cfg.seed)
    e, h = cfg.embed, cfg.hidden
    return {
        "E": draw.normal(0, 0.1, (cfg.num_words, e)),
        "W": draw.normal(0, 1 / np.sqrt(e), (e, h)),
        "U": np.linalg.qr(draw.normal(0, 1, (h, h)))[0] * 0.5,
        "b": np.zeros(h),
        "V": draw.normal(0, 1 / np.sqrt(h), (h, classes)),
        "c": np.zeros(classes),
    }


def forward(w: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, list]:
    """Class probabilities of each row of ``ids`` (rows, positions), and what backward needs."""
    ids = np.where((ids >= 0) & (ids < len(w["E"])), ids, 1)
    mask = ids != 0
    steps = int(mask.any(axis=0).nonzero()[0].max()) + 1 if mask.any() else 0
    x = w["E"][ids[:, :steps]]
    states = [np.zeros((len(ids), w["U"].shape[0]))]
    news = []
    for t in range(steps):
        new = np.tanh(x[:, t] @ w["W"] + states[-1] @ w["U"] + w["b"])
        news.append(new)
        states.append(np.where(mask[:, t, None], new, states[-1]))
    if steps:
        stacked = np.where(mask[:, :steps, None], np.stack(news, axis=1), -np.inf)
        top = stacked.argmax(axis=1)
        pooled = np.where(mask[:, :steps].any(axis=1)[:, None], stacked.max(axis=1), 0.0)
    else:
        top, pooled = np.zeros((len(ids), w["U"].shape[0]), np.int64), np.zeros((len(ids), w["U"].shape[0]))
    z = pooled @ w["V"] + w["c"]
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    return p, [ids[:, :steps], mask[:, :steps], x, states, news, top, pooled]


def loss_and_gradient(
    w: dict[str, np.ndarray], ids: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> tuple[float, dict[str, np.ndarray]]:
    """Summed weighted cross entropy of the rows, and its gradient (back-propagation in time)."""
    loss, g, touched, rows = _gradient(w, ids, y, weight)
    g["E"] = np.zeros_like(w["E"])
    g["E"][touched] = rows
    return loss, g


def _gradient(
    w: dict[str, np.ndarray], ids: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> tuple[float, dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """As :func:`loss_and_gradient`, the embedding's gradient as the ids touched and their rows, so that the cost is that
    of the words of the rows and not of the vocabulary."""
    p, (ids, mask, x, states, news, top, pooled) = forward(w, ids)
    rows = np.arange(len(y))
    loss = float(-(weight * np.log(np.maximum(p[rows, y], 1e-300))).sum())
    dz = p.copy()
    dz[rows, y] -= 1
    dz *= weight[:, None]
    g = {k: np.zeros_like(v) for k, v in w.items() if k != "E"}
    back = np.zeros((*ids.shape, w["W"].shape[1]))
    g["V"] = pooled.T @ dz
    g["c"] = dz.sum(axis=0)
    dpool = dz @ w["V"].T
    dh = np.zeros_like(dpool)
    for t in range(ids.shape[1] - 1, -1, -1):
        m = mask[:, t, None]
        da = (dh * m + dpool * (m & (top == t))) * (1 - news[t] ** 2)
        g["W"] += x[:, t].T @ da
        g["U"] += states[t].T @ da
        g["b"] += da.sum(axis=0)
        back[:, t] = da
        dh = da @ w["U"].T + dh * ~m
    flat = ids.ravel()
    order = np.argsort(flat, kind="stable")
    touched, first = np.unique(flat[order], return_index=True)
    sums = np.add.reduceat(back.reshape(len(flat), -1)[order], first, axis=0) if len(flat) else np.zeros((0, w["W"].shape[1]))
    return loss, g, touched, sums @ w["W"].T


def _matrix(ids: pa.Array) -> np.ndarray:
    """Lists of ids as rows padded with 0 to the longest; nulls count as 0."""
    import pyarrow.compute as pc

    sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), max(1, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = ids.flatten().fill_null(0).to_numpy(zero_copy_only=False)
    return out


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = _matrix(batch.column("ids"))
    y = batch.column("label_id").to_numpy(zero_copy_only=False).astype(np.int64)
    weight = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.float64)
    return out, y, weight


def _gradient_rows(weights: dict[str, np.ndarray], width: int, with_gradient: bool):
    """A function for ``mapInArrow``: the summed loss, weight and gradient of a task's rows, as
    rows (``key``, ``g0`` ... ``g{width-1}``): key -1 holds loss and weight, keys from 0 the
    embedding rows touched, then the other weights cut into rows."""
    names = [k for k in weights if k != "E"]
    vocab = len(weights["E"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, 0.0
        g = {k: np.zeros_like(v) for k, v in weights.items()} if with_gradient else None
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH):
                ids, y, weight = _columns(batch.slice(lo, _BATCH))
                if with_gradient:
                    loss, part, near, rows = _gradient(weights, ids, y, weight)
                    for k in part:
                        g[k] += part[k]
                    g["E"][near] += rows
                else:
                    p, _ = forward(weights, ids)
                    loss = float(-(weight * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum())
                total += loss
                seen += float(weight.sum())
        keys, rows = [-1], [np.r_[total, seen, np.zeros(width - 2)]]
        if with_gradient:
            touched = np.flatnonzero(np.abs(g["E"]).sum(axis=1))
            keys += touched.tolist()
            rows += list(g["E"][touched])
            flat = np.concatenate([g[k].ravel() for k in names])
            flat = np.r_[flat, np.zeros(-len(flat) % width)].reshape(-1, width)
            keys += list(range(vocab, vocab + len(flat)))
            rows += list(flat)
        matrix = np.vstack(rows)
        arrays = [pa.array(np.asarray(keys, np.int64))] + [pa.array(matrix[:, j]) for j in range(width)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key"] + [f"g{j}" for j in range(width)])

    return run


def summed(rows: DataFrame, weights: dict[str, np.ndarray], with_gradient: bool = True):
    """Loss per unit of weight over ``rows`` (``ids``, ``label_id``, ``weight``) and, if asked, the
    gradient of that mean, added up in Spark."""
    width = max(2, weights["E"].shape[1])
    schema = T.StructType(
        [T.StructField("key", T.LongType())] + [T.StructField(f"g{j}", T.DoubleType()) for j in range(width)]
    )
    parts = rows.select("ids", "label_id", "weight").mapInArrow(_gradient_rows(weights, width, with_gradient), schema)
    added = parts.groupBy("key").agg(*(F.sum(f"g{j}").alias(f"g{j}") for j in range(width))).toArrow()
    keys = added.column("key").to_numpy()
    matrix = np.column_stack([added.column(f"g{j}").to_numpy() for j in range(width)])
    head = matrix[keys == -1][0] if (keys == -1).any() else np.zeros(width)
    total, seen = float(head[0]), float(head[1])
    if not with_gradient:
        return total / max(seen, 1e-12), None
    vocab = len(weights["E"])
    g = {k: np.zeros_like(v) for k, v in weights.items()}
    rows_e = (keys >= 0) & (keys < vocab)
    g["E"][keys[rows_e]] = matrix[rows_e]
    dense = np.zeros(((sum(v.size for k, v in weights.items() if k != "E") + width - 1) // width, width))
    rest = keys >= vocab
    dense[keys[rest] - vocab] = matrix[rest]
    flat, at = dense.ravel(), 0
    for k, v in weights.items():
        if k == "E":
            continue
        g[k] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    scale = 1 / max(seen, 1e-12)
    return total * scale, {k: v * scale for k, v in g.items()}


def train(
    train_rows: DataFrame, val_rows: DataFrame, scratch: str, cfg: SequenceConfig = SequenceConfig()
) -> SequenceModel:
    """Fit on ``train_rows`` (``id``, ``ids``, ``label_id``, ``weight``), stopping on the loss of
    ``val_rows``. Rows with a null label or weight are left out."""
    spark = train_rows.sparkSession
    step = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(cfg.seed)), F.lit(cfg.steps)).cast("int")
    usable = (F.col("label_id").isNotNull()) & F.col("weight").isNotNull()
    train_rows.filter(usable).select("ids", "label_id", "weight", step.alias("step")).write.partitionBy("step").parquet(
        f"{scratch}/train"
    )
    val_rows.filter(usable).select("ids", "label_id", "weight").write.parquet(f"{scratch}/val")
    stored = spark.read.parquet(f"{scratch}/train")
    val = spark.read.parquet(f"{scratch}/val")
    w = initial_weights(cfg)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    beta1, beta2, t = 0.9, 0.999, 0
    model = SequenceModel({k: v.copy() for k, v in w.items()})
    best, waited = np.inf, 0
    for epoch in range(cfg.epochs):
        for s in range(cfg.steps):
            _, g = summed(stored.filter(F.col("step") == s), w)
            t += 1
            for k in w:
                first[k] = beta1 * first[k] + (1 - beta1) * g[k]
                second[k] = beta2 * second[k] + (1 - beta2) * g[k] ** 2
                rate = cfg.learning_rate * np.sqrt(1 - beta2**t) / (1 - beta1**t)
                w[k] = w[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        loss, _ = summed(val, w, with_gradient=False)
        model.history.append(loss)
        if loss < best:
            best, waited = loss, 0
            model.weights, model.best_epoch = {k: v.copy() for k, v in w.items()}, epoch + 1
        else:
            waited += 1
            if waited >= cfg.patience:
                break
    return model


def predict_proba(model: SequenceModel, rows: DataFrame, ids: str = "ids") -> DataFrame:
    """``rows`` plus ``p``, the class probabilities. The weights go to the tasks; their size is
    bounded by the vocabulary of the configuration."""
    weights = model.weights
    kept = [c for c in rows.columns if c != "p"]
    out = T.StructType([rows.schema[c] for c in kept] + [T.StructField("p", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH):
                part = batch.slice(lo, _BATCH)
                p, _ = forward(weights, _matrix(part.column(ids)))
                cols = [part.column(c) for c in kept] + [pa.array(list(p), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return rows.select(*kept).mapInArrow(run, out)
