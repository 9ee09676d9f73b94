"""Embeddings: positive PMI against a plain count, eigenvalues against numpy."""

import math
import random
import re
from collections import Counter

import numpy as np

from reviewlib.operators import embeddings

CFG = embeddings.EmbeddingConfig(num_words=12, window=2, k=4, iterations=40)


def texts(seed=1):
    draw = random.Random(seed)
    topics = [["red", "green", "blue", "cyan"], ["cat", "dog", "mouse", "bird"], ["one", "two", "three", "four"]]
    out = [(i, " ".join(draw.choice(topics[i % 3]) for _ in range(draw.randrange(3, 15)))) for i in range(60)]
    return out + [(100, None), (101, ""), (None, "red red")]


def plain_ppmi(rows, cfg):
    docs = [re.split(r"\s+", t.lower()) for i, t in rows if i is not None and t]
    counts = Counter(w for d in docs for w in d)
    kept = sorted(counts, key=lambda w: (-counts[w], w))[: cfg.num_words]
    index = {w: n + 1 for n, w in enumerate(kept)}
    co = Counter()
    for d in docs:
        ids = [(p, index[w]) for p, w in enumerate(d) if w in index]
        at = dict(ids)
        for p, i in ids:
            for dist in range(1, cfg.window + 1):
                if p + dist in at:
                    co[(i, at[p + dist])] += 1
                    co[(at[p + dist], i)] += 1
    marg = Counter()
    for (i, _), c in co.items():
        marg[i] += c
    total = sum(co.values())
    m = {(i, j): math.log(c * total / (marg[i] * marg[j])) for (i, j), c in co.items()}
    return index, {k: v for k, v in m.items() if v > 0}


def test_ppmi_and_singular_values_equal_plain_ones(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "id long, text string")
    words, m = embeddings.ppmi(df, "id", "text", CFG)
    index, want = plain_ppmi(rows, CFG)
    assert {r["token"]: r["i"] for r in words.collect()} == index
    got = {(r["i"], r["j"]): r["m"] for r in m.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    dense = np.zeros((len(index), len(index)))
    for (i, j), v in want.items():
        dense[i - 1, j - 1] = v
    values, vectors = embeddings.word_vectors(df, "id", "text", CFG)
    top = np.sort(np.linalg.svd(dense, compute_uv=False))[::-1][: CFG.k]
    np.testing.assert_allclose(np.sort(values)[::-1], top, rtol=1e-6)
    found = {r["token"]: np.array(r["vector"]) for r in vectors.collect()}
    assert set(found) == set(index) and all(len(v) == CFG.k for v in found.values())
    assert len(vectors.collect()) == len(index)


def test_no_words(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id long, text string")
    values, vectors = embeddings.word_vectors(df, "id", "text", CFG)
    assert len(values) == 0 and vectors.count() == 0


def test_pairs_are_counted_within_tasks(spark):
    texts = spark.createDataFrame([(["a", "x", "b", "a"],), ([],), (["b"],), (["a", "b"],)], "words array<string>")
    words = spark.createDataFrame([("a", 1), ("b", 2)], "token string, i int")
    found = {(r.i, r.j): r.c for r in embeddings._near(texts, words, 2).collect()}
    assert found == {(1, 2): 2, (2, 1): 1}
