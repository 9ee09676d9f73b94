"""NMF against numpy: same factors, the error never rises."""

import numpy as np

from reviewlib.operators import topics
from reviewlib.plans.queries import QUERIES


def numpy_nmf(v, ids, cfg):
    w = topics.start_w(np.array(ids), cfg.k)
    h = np.random.default_rng(cfg.seed).uniform(0.5, 1.0, (cfg.k, v.shape[1]))
    losses = []
    for r in range(cfg.rounds + 1):
        losses.append(((v - w @ h) ** 2).sum())
        if r == cfg.rounds:
            break
        h = h * (w.T @ v) / (w.T @ w @ h + 1e-12)
        w = w * (v @ h.T) / (w @ h @ h.T + 1e-12)
    return w, h, losses


def test_equals_numpy_and_error_falls(spark):
    draw = np.random.default_rng(2)
    v = draw.poisson(0.7, (30, 12)).astype(float)
    v[4] = 0  # a document without words has no row
    ids = [i * 3 + 1 for i in range(30)]
    rows = [(ids[d], t, float(v[d, t])) for d in range(30) for t in range(12) if v[d, t] > 0]
    df = spark.createDataFrame(rows, "d long, t int, v double")
    cfg = topics.TopicConfig(k=3, rounds=12)
    w, h, losses = topics.factorise(df, 12, cfg)
    keep = [d for d in range(30) if v[d].any()]
    want_w, want_h, want_losses = numpy_nmf(v[keep], [ids[d] for d in keep], cfg)
    np.testing.assert_allclose(h, want_h, rtol=1e-9)
    got = {r["d"]: np.array(r["w"]) for r in w.collect()}
    for n, d in enumerate(keep):
        np.testing.assert_allclose(got[ids[d]], want_w[n], rtol=1e-9)
    np.testing.assert_allclose(losses, want_losses, rtol=1e-9)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))


def test_query(spark):
    got = QUERIES["review_topics"](spark, "/root/testdata/sf0.001").collect()
    assert got and all(0 <= r["topic"] < 8 and len(r["top_words"]) == 5 for r in got)


def test_rounds_shuffle_no_entries(spark):
    rows = [(d, t, float(1 + (d + t) % 3)) for d in range(40) for t in range(6)]
    w, h, _ = topics.factorise(spark.createDataFrame(rows, "d long, t int, v double"), 6, topics.TopicConfig(k=2, rounds=1))
    assert w.columns == ["d", "w"] and w.count() == 40
    state = spark.createDataFrame([(1, [0, 2], [1.0, 3.0], [0.5, 2.0])], "d long, ts array<int>, vs array<double>, w array<double>")
    wtv, wtw = topics._products(state, 2, 3)
    assert wtv.tolist() == [[0.5, 0.0, 1.5], [2.0, 0.0, 6.0]]
    assert wtw.tolist() == [[0.25, 1.0], [1.0, 4.0]]


def test_blocks_of_few_documents_give_the_same(spark, monkeypatch):
    draw = np.random.default_rng(3)
    v = draw.poisson(0.9, (40, 9)).astype(float) + np.eye(40, 9)
    rows = [(d, t, float(v[d, t])) for d in range(40) for t in range(9) if v[d, t] > 0]
    keep = [d for d in range(40) if v[d].any()]
    monkeypatch.setattr(topics, "_DOCS", 3)
    cfg = topics.TopicConfig(k=2, rounds=5)
    w, h, losses = topics.factorise(spark.createDataFrame(rows, "d long, t int, v double").repartition(4), 9, cfg)
    want_w, want_h, want_losses = numpy_nmf(v[keep], keep, cfg)
    np.testing.assert_allclose(h, want_h, rtol=1e-9)
    np.testing.assert_allclose(losses, want_losses, rtol=1e-9)
    got = {r["d"]: r["w"] for r in w.collect()}
    np.testing.assert_allclose([got[d] for d in keep], want_w, rtol=1e-9)


def test_words_and_counts_follow_the_vocabulary_rule(spark):
    rows = [(1, "b a a, C!"), (2, "A b..."), (2, "b b"), (3, ""), (4, None), (None, "a a a a"), (5, "d"), (6, "c -")]
    words, docs = topics.term_matrix(spark.createDataFrame(rows, "id long, message string"), "id", "message", 3)
    assert sorted(words.collect()) == [("a", 1), ("b", 0), ("c", 2)]
    got = {r["d"]: dict(zip(r["ts"], r["vs"])) for r in docs.collect()}
    assert got == {1: {0: 1.0, 1: 2.0, 2: 1.0}, 2: {0: 3.0, 1: 1.0}, 6: {2: 1.0}}


def test_rounds_write_blocks_not_documents(spark, monkeypatch):
    seen = []
    plain = topics._stored

    def stored(df):
        out = plain(df)
        seen.append(out.count())
        return out

    monkeypatch.setattr(topics, "_stored", stored)
    rows = [(d, t, 1.0) for d in range(60) for t in range(3)]
    topics.factorise(spark.createDataFrame(rows, "d long, t int, v double").coalesce(1), 3, topics.TopicConfig(k=2, rounds=2))
    assert len(seen) == 3 and max(seen) <= 2 * 8  # a block and a row of sums a task
