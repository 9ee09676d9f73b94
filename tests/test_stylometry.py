"""Leave-one-out delta against a plain version in Python."""

import random
import statistics

from reviewlib.operators import stylometry

W = stylometry.FUNCTION_WORDS


def plain(rows):
    reviews = []
    for i, author, text in rows:
        if author is None:
            continue
        words = (text or "").lower().split()
        reviews.append((i, author, len(words), [words.count(w) for w in W]))
    authors = {}
    for i, a, t, c in reviews:
        total, counts = authors.get(a, (0, [0] * len(W)))
        authors[a] = (total + t, [x + y for x, y in zip(counts, c)])
    authors = {a: v for a, v in authors.items() if v[0] > 0}
    freq = {a: [c / t for c in counts] for a, (t, counts) in authors.items()}
    mu = [statistics.mean(f[k] for f in freq.values()) for k in range(len(W))]
    sd = [statistics.stdev(f[k] for f in freq.values()) if len(freq) > 1 else 0 for k in range(len(W))]

    def z(f, k):
        return (f - mu[k]) / sd[k] if sd[k] > 0 else 0.0

    out = {}
    for i, a, t, c in reviews:
        if t == 0:
            continue
        rest = authors[a][0] - t
        if rest <= 0:
            out[i] = None
            continue
        own = [z(c[k] / t, k) for k in range(len(W))]
        other = [z((authors[a][1][k] - c[k]) / rest, k) for k in range(len(W))]
        out[i] = round(sum(abs(x - y) for x, y in zip(own, other)) / len(W), 9)
    return out


def test_equals_plain_version_with_a_hot_author(spark):
    draw = random.Random(5)
    vocab = W + ["alpha", "beta", "gamma"]
    rows = [(i, "hot" if i % 3 else f"a{i % 7}", " ".join(draw.choice(vocab) for _ in range(draw.randrange(0, 30))))
            for i in range(300)]
    rows += [(900, None, "the the"), (901, "lonely", "the of"), (902, "a1", None), (903, "a2", "")]
    df = spark.createDataFrame(rows, "id long, author string, text string")
    got = {r["id"]: r["delta"] for r in stylometry.leave_one_out(stylometry.review_counts(df, "id", "author", "text")).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for i in want:
        assert (got[i] is None and want[i] is None) or abs(got[i] - want[i]) < 1e-8, i
    assert got[901] is None


def test_a_text_is_cut_into_words_once(spark):
    df = spark.createDataFrame([(1, "a", "The THE of, x"), (2, "a", None), (3, None, "the")], "id long, au string, m string")
    counts = stylometry.review_counts(df, "id", "au", "m")
    assert [(r.id, r.total, r.c_the, r.c_of, r.c_to) for r in counts.orderBy("id").collect()] == [(1, 4, 2, 1, 0), (2, 0, 0, 0, 0)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Scan", 1)[0].count("split(") == 1
