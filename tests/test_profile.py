import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlib.operators import prepare, profile


def reviews(spark, rows):
    return spark.createDataFrame(
        rows, "name string, rating string, number_of_photos string, message string"
    )


def test_prepare_columns(spark):
    df = reviews(
        spark,
        [
            ("  Ana  ", " 5 ", "", " Hi  http://spam "),
            ("CARLOS", "4", "10", "   Tudo   bem "),
            (None, "  3", None, None),
        ],
    )
    out = prepare.preprocess_reviews(df)
    assert out.columns[4:] == [
        "name_clean", "name_length", "rating_clean", "rating_length",
        "number_of_photos_clean", "number_of_photos_length", "message_clean", "message_length",
    ]
    got = [tuple(r)[4:] for r in out.collect()]
    assert got == [
        ("ana", 3, "5", 1, "0", 1, "hi", 2),
        ("carlos", 6, "4", 1, "10", 2, "tudo bem", 8),
        ("", 0, "3", 1, "0", 1, "", 0),
    ]
    assert [r.message for r in out.collect()] == [" Hi  http://spam ", "   Tudo   bem ", None]


def test_prepare_needs_its_column(spark):
    with pytest.raises(KeyError):
        prepare.prepare_columns(spark.range(1), "name")
    with pytest.raises(KeyError):
        prepare.preprocess_reviews(spark.createDataFrame([("a",)], "name string"))


def test_eda_features_without_columns(spark):
    with pytest.warns(UserWarning, match="rating"):
        out = prepare.eda_features(spark.createDataFrame([(" a b ",)], "message string"))
    (row,) = out.collect()
    assert (row.message, row["name"], row.rating, row.number_of_photos_norm) == ("a b", "", None, "0")
    assert (row.len_chars, row.len_words, row.has_url) == (3, 2, False)
    assert "rating_raw" not in out.columns


def test_null_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, s string")
    got = [tuple(r) for r in profile.null_counts(df).collect()]
    assert got == [(0, "x", "double", 2), (1, "s", "string", 2)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("a", 1.0), (None, None)], "`s.1` string, `x``y` double")
    assert [(r["column"], r.nulls) for r in profile.null_counts(df).collect()] == [
        ("s.1", 1), ("x`y", 1)]
    assert [(r["column"], r["count"]) for r in profile.describe(df).collect()] == [
        ("s.1", 1), ("x`y", 1)]


def test_describe_like_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {"s": rng.choice(["a", "b", "c", None], 200, p=[0.5, 0.2, 0.2, 0.1]),
         "x": np.where(rng.random(200) < 0.1, np.nan, rng.normal(size=200)),
         "n": rng.integers(0, 9, 200)}
    )
    df = spark.createDataFrame(
        [(s, None if np.isnan(x) else float(x), int(n)) for s, x, n in frame.itertuples(index=False)],
        "s string, x double, n int",
    )
    got = {r["column"]: r.asDict() for r in profile.describe(df).collect()}
    want = frame.describe(include="all").transpose()
    for c in ("s", "x", "n"):
        pairs = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                 ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "max"),
                 ("unique", "unique"), ("freq", "freq")]
        for theirs, ours in pairs:
            w, g = want.loc[c, theirs], got[c][ours]
            assert (pd.isna(w) and g is None) or g == pytest.approx(w), (c, ours)
    assert got["s"]["top"] == "a"


def test_quantiles_of_many_values_and_a_hot_one(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.lognormal(0, 9, 5_000), np.full(2_500, 3.0), -rng.random(7)])
    rows = [("a", float(v)) for v in x] + [("b", 1.0), ("b", 2.0), ("c", 5.0), ("c", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.631, 0.99, 1.0]
    got = {r.g: r.quantiles for r in profile.number_summary(df, "g", "x", probabilities).collect()}
    assert got["a"] == pytest.approx(np.quantile(x, probabilities).tolist())
    assert got["b"] == pytest.approx([1.0, 1.25, 1.5, 1.631, 1.99, 2.0])
    assert got["c"] == [5.0] * 6 and "d" not in got


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "s string, x double")
    got = [(r["column"], r["count"], r.unique, r.top, r["max"]) for r in profile.describe(df).collect()]
    assert got == [("s", 0, 0, None, None), ("x", 0, None, None, None)]


@pytest.mark.parametrize("values", [list(range(100)), [1, 5, 5, 9, 31], [4, 4, 4], [0, 61]])
def test_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "len_words int")
    got = profile.histogram(df).collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.high for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_of_nothing(spark):
    assert profile.histogram(spark.createDataFrame([], "len_words int")).collect() == []


def test_box_statistics(spark):
    rng = np.random.default_rng(5)
    rows = [(float(r), int(w)) for r in (1, 2, 3) for w in rng.geometric(0.05, 80)]
    rows += [(4.0, 7), (None, 3)]
    got = {r.rating: r for r in profile.box_statistics(
        spark.createDataFrame(rows, "rating double, len_words int")).collect()}
    assert set(got) == {1.0, 2.0, 3.0, 4.0}
    for rating, box in got.items():
        x = np.array([w for r, w in rows if r == rating], dtype=float)
        q1, q2, q3 = np.percentile(x, [25, 50, 75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (box["n"], box.q1, box.median, box.q3) == (len(x), q1, q2, q3)
        assert (box.whisker_low, box.whisker_high) == (min(inside.min(), q1), max(inside.max(), q3))


def test_duplicates(spark):
    rows = [(i, m) for i, m in enumerate(["a", "b", "a", "", None, "c", "a", "b", "d"])]
    df = spark.createDataFrame(rows, "id int, message string")
    got = sorted(r.id for r in profile.duplicate_messages(df).collect())
    assert got == [0, 1, 2, 3, 4, 6, 7]


def test_authors_ratings_suspects(spark):
    df = reviews(
        spark,
        [("b", "5", "0", "um dois três quatro"), ("a", "1", "0", "oi"), ("b", "x", "0", "a http://b c d e"),
         ("a", "5", "0", "um dois três quatro cinco"), ("c", "5", "0", "")],
    )
    eda = prepare.eda_features(df)
    assert [tuple(r) for r in profile.top_authors(eda, 2).collect()] == [("a", 2), ("b", 2)]
    assert [tuple(r) for r in profile.rating_distribution(eda).collect()] == [(1.0, 1), (5.0, 3)]
    suspects = {r.message for r in profile.suspect_reviews(eda).collect()}
    assert suspects == {"oi", "a http://b c d e", ""}


def test_reports_read_only_their_columns(spark, tmp_path):
    df = reviews(spark, [("a", "1", "0", "x")]).withColumn("id", F.lit(1))
    df.write.parquet(str(tmp_path / "t"))
    stored = prepare.eda_features(spark.read.parquet(str(tmp_path / "t")))
    plan = profile.top_authors(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan
