"""All-pairs cosine join against a brute-force version."""

import math
import random
from collections import Counter

from reviewlib.operators import similarity

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omicron pi rho".split()


def texts(seed=3, n=120):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        base = [draw.choice(WORDS[: 4 + i % 12]) for _ in range(draw.randrange(1, 12))]
        out.append((i, " ".join(base)))
    out += [(200, out[5][1]), (201, out[5][1]), (202, None), (203, ""), (204, "!!! ..."), (None, "alpha beta")]
    out += [(205, "the " * 50 + "x"), (206, "the " * 49 + "x y")]
    return out


def brute(rows, threshold):
    import re

    counts = {}
    for i, t in rows:
        if i is None:
            continue
        words = [w for w in re.split(r"[\t-\r ]+", re.sub(r"[!-/:-@\[-`{-~]", "", (t or "").lower())) if w]
        if words:
            counts[i] = Counter(words)
    n = len(counts)
    df = Counter(w for c in counts.values() for w in c)
    vec = {}
    for i, c in counts.items():
        raw = {w: tf * (math.log((n + 1) / (df[w] + 1)) + 1) for w, tf in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vec[i] = {w: v / norm for w, v in raw.items()}
    out = set()
    ids = sorted(vec)
    for x in ids:
        for y in ids:
            if x < y:
                dot = round(sum(v * vec[y].get(w, 0) for w, v in vec[x].items()), 9)
                if dot >= threshold:
                    out.add((x, y, dot))
    return out


def test_pairs_equal_brute_force_with_hot_terms_split(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "id long, message string")
    vectors = similarity.tfidf(similarity.term_counts(df, "id", "message"))
    for threshold, hot in ((0.8, 10_000), (0.8, 3), (0.5, 5)):
        got = {tuple(r) for r in similarity.similar_pairs(vectors, threshold, hot).collect()}
        want = brute(rows, threshold)
        assert {(a, b) for a, b, _ in got} == {(a, b) for a, b, _ in want}
        assert all(abs(c - dict(((a, b), c) for a, b, c in want)[(a, b)]) < 1e-8 for a, b, c in got)
    assert (200, 201) in {(a, b) for a, b, _ in got}


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id long, message string")
    vectors = similarity.tfidf(similarity.term_counts(df, "id", "message"))
    assert similarity.similar_pairs(vectors).count() == 0


def test_copies_are_searched_once_and_given_out_whole(spark):
    rows = texts() + [(1000 + i, "ok") for i in range(60)] + [(2000 + i, "ok alpha alpha") for i in range(30)]
    vectors = similarity.tfidf(similarity.term_counts(spark.createDataFrame(rows, "id long, message string"), "id", "message"))
    members, pairs = similarity.similar_classes(vectors, 0.5, 3)
    reps = dict(members.collect())
    assert {reps[1000 + i] for i in range(60)} == {1000} and {reps[2000 + i] for i in range(30)} == {2000}
    assert all(a in reps.values() and b in reps.values() for a, b, _ in pairs.collect())
    got = [(a, b) for a, b, _ in similarity.similar_pairs(vectors, 0.5, 3).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a, b, _ in brute(rows, 0.5)}


def test_vectors_cut_over_groups_of_terms_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "_BLOCK", 16)
    monkeypatch.setattr(similarity, "_GROUP", 3)
    monkeypatch.setattr(similarity, "_MEMBERS", 2)
    vectors = similarity.tfidf(similarity.term_counts(spark.createDataFrame(texts(), "id long, message string"), "id", "message"))
    got = similarity.similar_pairs(vectors).collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a, b, _ in brute(texts(), 0.8)}


def test_reach_is_a_running_sum(spark):
    # a frame to the end of the partition is summed anew for each of an author's terms
    rows = [(1, "t", 0.6, 2, 0.6), (1, "u", 0.8, 3, 0.8), (2, "t", 1.0, 2, 1.0)]
    placed = spark.createDataFrame(rows, "id long, tid string, w double, df long, top double")
    plan = similarity._candidates(placed, 0.8, 10)._jdf.queryExecution().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_terms_of_a_repeated_id_follow_the_vocabulary_rule(spark):
    """Words are cut from whole texts in tasks and counted there; what is left of them is the rule's."""
    from pyspark.sql import functions as F

    from reviewlib.operators.vocabulary import tokens

    rows = [
        ("a", "It's ÀÉ it_s\u00a0x ITS\x0b--\ta,b\r\n."), ("a", "its ... İ ß\x1cq\x85r"), ("b", "!!"), ("b", " \t"),
        (None, "its"), ("c", None), ("d", "x" * 9_000_000 + " y Y"), ("a", "Its"), ("b", "é -É- ~"),
    ]
    df = spark.createDataFrame(rows, "who string, message string").coalesce(1)
    words = df.filter("who IS NOT NULL").select("who", F.explode(tokens("message")).alias("term"))
    want = {tuple(r) for r in words.groupBy("who", "term").count().collect()}
    counts = similarity.term_counts(df, "who", "message")
    assert {tuple(r) for r in counts.collect()} == want
    assert {("a", "its", 4), ("a", "its\u00a0x", 1), ("a", "ÀÉ", 1), ("d", "y", 2)} <= want
    # no row per word reaches the shuffle
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
