"""Rater EM against a numpy version; noisy labels get low probabilities."""

import random

import numpy as np

from reviewlib.functions.patterns import LABELS
from reviewlib.operators import raters
from reviewlib.plans.queries import QUERIES

LABELS = ("negative", "neutral", "positive")


def numpy_em(obs, raters_, k=3, rounds=50, tol=1e-9, smoothing=0.01):
    items = sorted({i for i, _, _ in obs})
    at = {i: n for n, i in enumerate(items)}
    rid = {r: n for n, r in enumerate(raters_)}
    post = np.zeros((len(items), k))
    for i, _, l in obs:
        post[at[i], l] += 1
    post /= post.sum(1, keepdims=True)

    def estimate(post):
        prior = post.sum(0) + smoothing
        prior /= prior.sum()
        conf = np.full((len(raters_), k, k), smoothing)
        for i, r, l in obs:
            conf[rid[r], :, l] += post[at[i]]
        return prior, conf / conf.sum(2, keepdims=True)

    prior, conf = estimate(post)
    for _ in range(rounds):
        lg = np.tile(np.log(prior), (len(items), 1))
        for i, r, l in obs:
            lg[at[i]] += np.log(conf[rid[r], :, l])
        e = np.exp(lg - lg.max(1, keepdims=True))
        post = e / e.sum(1, keepdims=True)
        new_prior, new_conf = estimate(post)
        moved = max(np.abs(new_prior - prior).max(), np.abs(new_conf - conf).max())
        prior, conf = new_prior, new_conf
        if moved <= tol:
            break
    return dict(zip(items, post)), prior, conf


def observations(seed=3, n=300):
    draw = random.Random(seed)
    out = []
    noise = {"a": 0.1, "b": 0.3, "c": 0.5}
    for i in range(n):
        truth = draw.choices(range(3), [0.2, 0.2, 0.6])[0]
        for r, q in noise.items():
            if draw.random() < 0.85:
                out.append((i, r, truth if draw.random() > q else draw.randrange(3)))
    return out


def test_equals_numpy(spark):
    obs = observations()
    rows = [(i, r, LABELS[l]) for i, r, l in obs] + [(None, "a", "positive"), (5, None, "neutral"), (6, "a", "odd")]
    df = spark.createDataFrame(rows, "item long, rater string, label string")
    posterior, prior, confusion = raters.reconcile(df)
    want_post, want_prior, want_conf = numpy_em(obs, ["a", "b", "c"])
    np.testing.assert_allclose(prior, want_prior, atol=1e-9)
    for n, r in enumerate(["a", "b", "c"]):
        np.testing.assert_allclose(confusion[r], want_conf[n], atol=1e-9)
    got = {row["item"]: np.array(row["p"]) for row in posterior.collect()}
    assert got.keys() == want_post.keys()
    for i in got:
        np.testing.assert_allclose(got[i], want_post[i], atol=1e-8)
    # the noisiest rater is found noisiest
    assert np.trace(confusion["a"]) > np.trace(confusion["b"]) > np.trace(confusion["c"])


def test_query_on_smallest_tables(spark):
    got = QUERIES["weak_labels"](spark, "/root/testdata/sf0.01").collect()
    assert got and all(0 <= r["p_label"] <= 1 for r in got)
    assert all(r["p_cell"] is None or r["p_cell"] <= r["p_label"] + 1e-12 for r in got)


def test_rounds_run_over_patterns(spark, monkeypatch):
    rows = [(i, r, LABELS[(i * k) % 3]) for i in range(300) for k, r in ((1, "x"), (2, "y"))] + [(7, "x", LABELS[0])]
    sizes = []
    stored = raters._stored
    monkeypatch.setattr(raters, "_stored", lambda df: (out := stored(df), sizes.append((out.columns, out.count())))[0])
    posterior, _, _ = raters.reconcile(spark.createDataFrame(rows, "item long, rater string, label string"), rounds=2)
    assert posterior.count() == 300
    assert all(n <= 4 * 3 for columns, n in sizes if "item" not in columns)
