"""The recurrent classifier: gradients by finite differences, Spark sums against numpy, training."""

import numpy as np
import pyarrow as pa
import pytest

from reviewlib.operators import sequence
from reviewlib.plans.queries import QUERIES

CFG = sequence.SequenceConfig(num_words=40, embed=4, hidden=5, epochs=6, steps=2, learning_rate=0.05)


def data(rows=60, seed=1):
    draw = np.random.default_rng(seed)
    ids = draw.integers(2, 40, (rows, 9))
    ids[::5, 4:] = 0
    ids[3] = 0  # a text without words
    y = (ids == 7).any(axis=1).astype(int) + (ids == 8).any(axis=1).astype(int)
    weight = draw.random(rows) + 0.5
    return ids, y, weight


def test_gradient_by_finite_differences():
    w = sequence.initial_weights(CFG)
    ids, y, weight = data(12)
    _, g = sequence.loss_and_gradient(w, ids, y, weight)
    draw = np.random.default_rng(2)
    for k in w:
        for _ in range(6):
            at = tuple(int(draw.integers(0, s)) for s in w[k].shape)
            old = w[k][at]
            w[k][at] = old + 1e-6
            up, _ = sequence.loss_and_gradient(w, ids, y, weight)
            w[k][at] = old - 1e-6
            down, _ = sequence.loss_and_gradient(w, ids, y, weight)
            w[k][at] = old
            numeric = (up - down) / 2e-6
            assert abs(numeric - g[k][at]) <= 1e-5 * (abs(numeric) + 1e-3), (k, at)


def frame(spark, ids, y, weight):
    rows = [(i, [int(v) for v in r], int(l), float(x)) for i, (r, l, x) in enumerate(zip(ids, y, weight))]
    rows += [(1000, [], 0, 1.0), (1001, [1, 2], None, 1.0)]
    return spark.createDataFrame(rows, "id long, ids array<int>, label_id int, weight double").repartition(3)


def test_spark_sums_equal_numpy(spark):
    w = sequence.initial_weights(CFG)
    ids, y, weight = data()
    df = frame(spark, ids, y, weight).filter("label_id IS NOT NULL")
    loss, g = sequence.summed(df, w)
    ids2 = np.vstack([ids, np.zeros((1, ids.shape[1]), int)])
    local_loss, local = sequence.loss_and_gradient(w, ids2, np.r_[y, 0], np.r_[weight, 1.0])
    total = weight.sum() + 1.0
    assert loss == pytest.approx(local_loss / total)
    for k in w:
        np.testing.assert_allclose(g[k], local[k] / total, atol=1e-12)


def test_training_stops_early_and_keeps_the_best(spark, tmp_path):
    ids, y, weight = data(200)
    df = frame(spark, ids, y, weight)
    model = sequence.train(df, df, str(tmp_path / "a"), CFG)
    assert 1 <= model.epochs_trained <= CFG.epochs
    assert model.history[model.best_epoch - 1] == min(model.history)
    assert model.history[-1] < model.history[0] or model.epochs_trained < CFG.epochs
    wild = sequence.SequenceConfig(num_words=40, embed=4, hidden=5, epochs=30, steps=2, learning_rate=5.0)
    stopped = sequence.train(df, df, str(tmp_path / "b"), wild)
    assert stopped.epochs_trained - stopped.best_epoch <= wild.patience
    scored = sequence.predict_proba(model, df.select("id", "ids")).collect()
    assert len(scored) == 202 and all(abs(sum(r["p"]) - 1) < 1e-9 for r in scored)
    accuracy = np.mean([np.argmax(r["p"]) == l for r, l in zip(sorted(scored, key=lambda r: r["id"])[:200], y)])
    assert accuracy > np.bincount(y).max() / len(y)


def test_query_runs_on_the_smallest_tables(spark):
    (row,) = QUERIES["train_sequence_metrics"](spark, "/root/testdata/sf0.001").collect()
    assert 1 <= row["epochs_trained"] <= 20 and 1 <= row["best_epoch"] <= row["epochs_trained"]
    assert 0 <= row["test_acc"] <= 1 and np.isfinite(row["test_loss"]) and row["labels"] == ["negative", "neutral", "positive"]


def test_gradient_of_touched_words_only():
    cfg = sequence.SequenceConfig(num_words=1_000, embed=4, hidden=4)
    w = sequence.initial_weights(cfg)
    ids = np.array([[5, 9, 5, 0], [7, 0, 0, 0]])
    _, g, touched, rows = sequence._gradient(w, ids, np.array([0, 2]), np.ones(2))
    assert "E" not in g and touched.tolist() == [0, 5, 7, 9] and rows.shape == (4, 4)
    assert sequence._matrix(pa.array([[3, None], None, [1, 2, 4]])).tolist() == [[3, 0, 0], [0, 0, 0], [1, 2, 4]]
