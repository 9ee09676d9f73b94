"""The search over blocks of texts, against the brute-force version and the search over terms."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlib.operators import similar_texts, similarity
from reviewlib.plans.queries import QUERIES
from test_similarity import WORDS, brute, texts


def rows():
    draw = random.Random(8)
    out = texts(n=150) + [(1000 + i, " ".join(draw.choices(WORDS, k=draw.randrange(2, 9)) + [f"own{i}", f"too{i}"])) for i in range(60)]
    out += [(2000 + i, "ok") for i in range(30)] + [(2100 + i, "OK, ok!") for i in range(5)]
    out += [(3000 + i, f"only{i}") for i in range(5)]
    return out


def pairs_of(spark, data, threshold):
    df = spark.createDataFrame(data, "id long, message string")
    return similarity.expanded(*similar_texts.similar_classes(df, "id", "message", threshold), threshold).collect()


@pytest.mark.parametrize("small", [False, True])
def test_pairs_equal_brute_force(spark, monkeypatch, small):
    if small:  # several chunks and blocks, and terms that differ from one to the next
        for name, value in (("_CHUNK", 900), ("_DOCS", 7), ("_ENTRIES", 40), ("_PARTS", 3)):
            monkeypatch.setattr(similar_texts, name, value)
        monkeypatch.setattr(similarity, "_PAIRS", 50)
    data = rows()
    for threshold in (0.8, 0.5):
        got = pairs_of(spark, data, threshold)
        want = {(a, b): c for a, b, c in brute(data, threshold)}
        assert len(got) == len(want) and {(a, b) for a, b, _ in got} == set(want)
        assert all(abs(c - want[a, b]) < 1e-8 for a, b, c in got)


def test_texts_of_a_repeated_id_count_together(spark):
    data = [(1, "alpha beta"), (1, "Beta gamma"), (1, None), (2, "beta alpha, beta gamma"), (3, "alpha"), (3, "alpha"), (4, "delta"), (4, "")]
    df = spark.createDataFrame(data, "id long, message string").repartition(4)
    members, pairs = similar_texts.similar_classes(df, "id", "message")
    assert sorted(members.collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    vectors = similarity.tfidf(similarity.term_counts(df, "id", "message"))
    assert sorted(similarity.similar_classes(vectors)[0].collect()) == sorted(members.collect())
    assert pairs.count() == 0


def test_no_rows(spark):
    assert pairs_of(spark, [(1, None), (2, ""), (None, "alpha")], 0.8) == []


def test_equal_vectors_over_chunks_are_one_class(spark, monkeypatch):
    monkeypatch.setattr(similar_texts, "_CHUNK", 1)
    data = [(i, "one two" if i % 2 else "two one") for i in range(20)] + [(50, "lone"), (51, "single")]
    members, _ = similar_texts.similar_classes(spark.createDataFrame(data, "id long, message string"), "id", "message")
    assert sorted(members.collect()) == [(i, 0) for i in range(20)] + [(50, 50), (51, 51)]


def test_bounds_are_never_below_the_cosine(spark):
    df = spark.createDataFrame(rows(), "id long, message string")
    placed, total = similar_texts._placed(df, "id", "message")
    kept = placed.select("chunk", F.sequence(F.lit(0), F.size("ids") - 1).alias("ats"))
    batches = similar_texts._blocks(placed, kept, total, 2).toArrow().combine_chunks().to_batches()
    table = [{c: b.column(c)[i] for c in b.schema.names} for b in batches for i in range(b.num_rows)]
    blocks = [similar_texts._Block(r, total, np.array(table[0]["heavy"].as_py()[:4])) for r in table]
    for a in blocks:
        for b in blocks:
            xs, ys = (x.ravel() for x in np.indices((len(a.order), len(b.order))))
            dots = similar_texts._dots(a, b, a.order[xs], b.order[ys])
            for x, y in zip(a.lengths, b.lengths):
                assert ((x @ y.T).ravel() - dots > -1e-4).all()


def test_no_table_has_a_row_per_term(spark, monkeypatch):
    seen = []
    plain = similarity._stored

    def stored(df):
        out = plain(df)
        seen.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(similarity, "_stored", stored)
    monkeypatch.setattr(similar_texts, "_stored", stored)
    found = QUERIES["similar_reviews"](spark, "/root/testdata/sf0.001").count()
    texts_ = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert seen and found and all(n <= texts_ for _, n in seen), seen
