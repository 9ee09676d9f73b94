"""The inverted-file index: recall against brute force, hot cells cut into chunks, awkward rows."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from reviewlib.operators import vector_index
from reviewlib.plans.oracles import ORACLES

SF = "/root/testdata/sf0.1"


def test_recall_at_10_against_brute_force_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    truth = {}
    for q, _, i, _ in con.execute(ORACLES["nearest_vectors"]).fetchall():
        truth.setdefault(q, set()).add(i)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    index = vector_index.build(vectors, 64)
    queries = vectors.filter(F.col("id") % 100 == 0).select(F.col("id").alias("query"), "v")
    got = {}
    for r in vector_index.search(index, queries, 64).collect():
        got.setdefault(r["query"], set()).add(r["id"])
    recall = sum(len(got.get(q, set()) & s) for q, s in truth.items()) / sum(len(s) for s in truth.values())
    assert recall >= 0.9, recall
    assert index.table.count() == rows.count()


def test_exact_when_every_cell_is_probed_and_a_hot_cell_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "CHUNK", 7)
    draw = np.random.default_rng(3)
    x = np.vstack([draw.normal(0, 1, (150, 4)), np.zeros((30, 4)), draw.normal(5, 0.1, (20, 4))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<float>")
    cfg = vector_index.IndexConfig(cells=4, probes=4, shortlist=500, k=5)
    index = vector_index.build(df, 4, cfg)
    assert index.table.select("chunk").distinct().count() > 1
    queries = df.filter(F.col("id") % 10 == 0).select(F.col("id").alias("query"), "v")
    got = {(r["query"], r["rank"]): (r["id"], r["distance"]) for r in vector_index.search(index, queries, 4, cfg).collect()}
    x32 = x.astype(np.float32).astype(np.float64)
    for q in range(0, len(x), 10):
        d = ((x32 - x32[q]) ** 2).sum(1).round(9)
        order = sorted((d[i], i) for i in range(len(x)) if i != q)[:5]
        assert [got[(q, r + 1)][0] for r in range(5)] == [i for _, i in order]


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, v array<float>")
    index = vector_index.build(df, 4)
    assert vector_index.search(index, df.select(F.col("id").alias("query"), "v"), 4).count() == 0
