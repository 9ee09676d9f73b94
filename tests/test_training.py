import json
import math

import pytest
from pyspark.sql import functions as F

from reviewlib import sources
from reviewlib.operators import classifier, evaluation, split, vocabulary
from reviewlib.plans import jobs
from reviewlib.plans.views import SENTENCES, view

SF = "/root/testdata/sf0.01"


def counts(spark, **n):
    return spark.createDataFrame(list(n.items()), "label string, n long")


def quotas(df):
    return {r.label: (r.n_train, r.n_val, r.n_test) for r in df.collect()}


def test_worked_quotas(spark):
    got = quotas(split.split_quotas(counts(spark, negative=51, neutral=49, positive=299)))
    assert got == {"negative": (36, 8, 7), "neutral": (34, 7, 8), "positive": (209, 45, 45)}


def test_quotas_add_up(spark):
    for n in ((10, 11, 979), (27, 2178, 57), (7, 7, 7), (100, 3, 50)):
        sizes = dict(zip(("a", "b", "c"), n))
        got = quotas(split.split_quotas(counts(spark, **sizes)))
        total, held = sum(n), math.ceil(0.3 * sum(n))
        assert {k: sum(v) for k, v in got.items()} == sizes
        assert sum(v[0] for v in got.values()) == total - held
        assert sum(v[2] for v in got.values()) == math.ceil(0.5 * held)


def test_too_small_to_split(spark):
    with pytest.raises(Exception, match="fewer than 2 rows: b"):
        split.split_quotas(counts(spark, a=50, b=1, c=50)).collect()
    with pytest.raises(Exception, match="smaller than the number of classes"):
        split.split_quotas(counts(spark, a=2, b=2, c=2)).collect()


def test_split_follows_the_hash_order_under_skew(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 50 == 0, "negative").when(F.col("id") % 77 == 1, "neutral")
        .when(F.col("id") % 1000 == 3, "other").when(F.col("id") % 1000 == 7, None)
        .otherwise("positive").alias("label"),
    )
    got = split.stratified_split(rows).collect()
    known = rows.filter("label in ('negative', 'neutral', 'positive')")
    want = quotas(split.split_quotas(known.groupBy("label").agg(F.count("*").alias("n"))))
    assert len(got) == known.count()
    import hashlib

    for label, (train, val, test) in want.items():
        mine = [r for r in got if r.label == label]
        mine.sort(key=lambda r: hashlib.md5(f"42-{r.review_id}".encode()).hexdigest())
        assert [r.split for r in mine] == ["train"] * train + ["val"] * val + ["test"] * test


def test_split_does_not_depend_on_partitions(spark):
    rows = view(spark, SF, SENTENCES)
    a = split.stratified_split(rows, id="doc_id").select("doc_id", "split")
    b = split.stratified_split(rows.repartition(13), id="doc_id").select("doc_id", "split")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_labels_round_trip(spark):
    df = spark.createDataFrame([("negative",), ("neutral",), ("positive",), ("x",), (None,)], "l string")
    got = df.select(split.encode_label("l").alias("i")).select("i", split.decode_label("i")).collect()
    assert [tuple(r) for r in got] == [
        (0, "negative"), (1, "neutral"), (2, "positive"), (None, None), (None, None)]


def test_class_weights(spark):
    rows = [("negative",)] * 27 + [("neutral",)] * 2178 + [("positive",)] * 57
    got = {r.label_id: r.weight for r in split.class_weights(
        spark.createDataFrame(rows, "label string")).collect()}
    assert got == pytest.approx({0: 27.925925925925927, 1: 0.34618916437098257, 2: 13.228070175438596})
    with pytest.raises(Exception, match="no rows labelled positive"):
        split.class_weights(spark.createDataFrame(rows[:30], "label string")).collect()


def test_vocabulary_and_sequences(spark):
    df = spark.createDataFrame(
        [(1, "B b, a! É é a c"), (2, "a z"), (3, ""), (4, None), (5, "!? -")],
        "review_id int, message string",
    )
    vocab = vocabulary.build_vocabulary(df)
    assert [tuple(r) for r in vocab.orderBy("token_id").collect()] == [
        ("a", 2, 3), ("b", 3, 2), ("é", 4, 1), ("É", 5, 1), ("z", 6, 1), ("c", 7, 1)]
    small = vocabulary.build_vocabulary(df, num_words=4)
    assert {r.token for r in small.collect()} == {"a", "b"}
    got = {r.review_id: r.ids for r in vocabulary.encode_sequences(df, small, seq_len=5).collect()}
    assert got == {1: [3, 3, 2, 1, 1], 2: [2, 1, 0, 0, 0], 3: [0] * 5, 4: [0] * 5, 5: [0] * 5}


def test_pipeline_words_are_the_vectorisers(spark):
    df = spark.createDataFrame([("B b, a! É 'x' [y]\\ z_w\t\n{q}~`^",), ("",)], "_text string")
    stage = classifier.word_cutter()
    assert [r["_tokens"] for r in stage.transform(df).collect()] == [
        r[0] for r in df.select(vocabulary.tokens("_text")).collect()
    ]


def predictions(spark):
    rows = [("negative", "negative", [0.8, 0.1, 0.1]), ("negative", "positive", [0.2, 0.0, 0.8]),
            ("positive", "positive", [0.0, 0.0, 1.0]), ("positive", "negative", [1.0, 0.0, 0.0])]
    return spark.createDataFrame(rows, "label string, pred string, p array<double>")


def test_accuracy_and_loss(spark):
    (row,) = evaluation.accuracy_and_loss(predictions(spark)).collect()
    want = -(math.log(0.8) + math.log(0.2) + math.log(1 - 1e-7) + math.log(1e-7)) / 4
    assert (row.test_acc, row.test_loss) == (0.5, pytest.approx(want))


def test_matrix_and_report(spark):
    df = predictions(spark)
    assert [tuple(r) for r in evaluation.confusion_matrix(df).collect()] == [
        ("negative", 1, 0, 1), ("neutral", 0, 0, 0), ("positive", 1, 0, 1)]
    report = {r.label: tuple(r)[1:] for r in evaluation.classification_report(df).collect()}
    assert report["negative"] == report["positive"] == (0.5, 0.5, 0.5, 2)
    assert report["neutral"] == (0.0, 0.0, 0.0, 0)
    assert report["macro avg"] == pytest.approx((1 / 3, 1 / 3, 1 / 3, 4))
    assert report["weighted avg"] == (0.5, 0.5, 0.5, 4)
    (metrics,) = evaluation.compute_metrics(df).collect()
    assert tuple(metrics) == pytest.approx((0.5, 1 / 3, 0.5, 4))


def test_most_likely_takes_the_lowest_id(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],)], "p array<double>")
    assert [r[0] for r in df.select(classifier.most_likely("p")).collect()] == ["negative", "positive"]


def test_no_model(spark):
    with pytest.raises(ValueError, match="no model"):
        classifier.predict_labels(None, spark.createDataFrame([("x",)], "message string"))


def test_train_save_load_predict(spark, tmp_path):
    words = {"negative": "ruim péssimo demorou", "neutral": "razoável normal", "positive": "ótimo bom"}
    rows = [
        (i, f"{words[label].split()[i % 2]} comida {i % 5} http://x.y @ana", label)
        for i, label in enumerate(["negative", "neutral", "positive"] * 40)
    ]
    df = spark.createDataFrame(rows + [(999, None, "neutral")], "review_id int, message string, label string")
    csv = str(tmp_path / "labeled")
    sources.write_csv(df.drop("review_id"), csv)
    out = str(tmp_path / "out")
    (metrics,) = jobs.train_job(spark, csv, out).collect()
    assert metrics.test_acc == 1.0 and metrics.test_loss < 0.5 and metrics.epochs_trained > 0
    assert metrics.labels == ["negative", "neutral", "positive"]
    assert set(metrics.class_weight) == {"0", "1", "2"}

    (text,) = [p.read_text() for p in (tmp_path / "out" / "metrics").glob("*.json")]
    assert set(json.loads(text)) == {"test_loss", "test_acc", "epochs_trained", "class_weight", "labels"}

    model = sources.load_model(f"{out}/model")
    asked = spark.createDataFrame([("ótimo",), ("ruim!",), ("normal",), (None,)], "message string")
    got = classifier.predict_labels(model, asked).collect()
    assert [r.pred for r in got[:3]] == ["positive", "negative", "neutral"]
    assert all(sum(r.p) == pytest.approx(1) for r in got)

    scored = spark.createDataFrame([("negative", "neutral")], "label string, pred string")
    jobs.evaluate_job(scored, out, "all")
    assert list((tmp_path / "out" / "all_metrics").glob("*.json"))
    assert list((tmp_path / "out" / "all_confusion_matrix").glob("*.csv"))
