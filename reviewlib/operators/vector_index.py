"""Nearest vectors by an inverted-file index: k-means cells, residual codes, exact re-ranking.

``fit`` learns cell centres by k-means on a sample of at most ``sample`` vectors (a documented
bound: the centres, ``cells x dims``, are all the driver holds), and a scale per dimension for
residual codes. ``build`` indexes every vector: its nearest centre, and its residual to that
centre as signed bytes. ``search`` sends each query to its ``probes`` nearest cells; in a cell,
numpy scores the query against the codes (an approximate distance) and keeps the best
``shortlist``; the shortlist is re-ranked by exact distance from the stored vectors and the best
``k`` kept. A cell of many vectors is cut into chunks of at most ``CHUNK``, each scored by itself
with the queries copied to it, so no task holds a large cell whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.scratch import scratch_dir

CHUNK = 20_000


@dataclass(frozen=True)
class IndexConfig:
    cells: int | None = None  # default: about the square root of the rows
    sample: int = 20_000
    iterations: int = 20
    probes: int = 32
    shortlist: int = 100
    k: int = 10
    seed: int = 11


@dataclass
class Index:
    centres: np.ndarray
    scale: np.ndarray
    table: DataFrame  # id, cell, chunk, code, vector


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _nearest(x: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def fit(vectors: DataFrame, dims: int, cfg: IndexConfig = IndexConfig()) -> tuple[np.ndarray, np.ndarray]:
    """Centres and residual scales from k-means on a bounded sample of ``vectors`` (``id``, ``v``)."""
    total = vectors.count()
    cells = cfg.cells or max(1, int(round(np.sqrt(total))))
    fraction = min(1.0, cfg.sample / max(total, 1))
    rows = vectors.sample(fraction=fraction, seed=cfg.seed).limit(cfg.sample).select("v").toArrow()
    x = _matrix(rows.column("v"), dims) if rows.num_rows else np.zeros((0, dims))
    if len(x) == 0:
        return np.zeros((0, dims)), np.ones(dims)
    draw = np.random.default_rng(cfg.seed)
    centres = x[draw.choice(len(x), size=min(cells, len(x)), replace=False)].copy()
    for _ in range(cfg.iterations):
        at = _nearest(x, centres)[:, 0]
        for c in range(len(centres)):
            members = x[at == c]
            if len(members):
                centres[c] = members.mean(axis=0)
    residual = x - centres[_nearest(x, centres)[:, 0]]
    scale = np.maximum(np.abs(residual).max(axis=0), 1e-9) / 127
    return centres, scale


def build(vectors: DataFrame, dims: int, cfg: IndexConfig = IndexConfig()) -> Index:
    """Every vector of ``vectors`` (``id``, ``v``, non-null, ``dims`` long) in its cell, with its
    residual code; written to the scratch folder."""
    spark = vectors.sparkSession
    centres, scale = fit(vectors, dims, cfg)
    schema = "id long, cell int, code binary, v array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dims)
            cell = _nearest(x, centres)[:, 0] if len(x) else np.zeros(0, np.int64)
            codes = np.clip(np.round((x - centres[cell]) / scale), -127, 127).astype(np.int8) if len(x) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 batch.column("v")],
                names=["id", "cell", "code", "v"],
            )

    placed = vectors.select(F.col("id").cast("long"), F.col("v").cast("array<float>")).mapInArrow(run, schema)
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    chunked = placed.join(sizes, "cell").withColumn(
        "chunk", (F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / CHUNK))).cast("int")
    ).drop("n")
    path = scratch_dir(spark)
    chunked.write.parquet(path)
    return Index(centres, scale, spark.read.parquet(path))


def search(index: Index, queries: DataFrame, dims: int, cfg: IndexConfig = IndexConfig()) -> DataFrame:
    """``query``, ``rank`` (from 1), ``id``, ``distance`` (squared, exact, rounded to 9 decimals) of the ``k`` nearest
    indexed vectors of each query (``query``, ``v``), the query's own id left out; ties by id."""
    centres, scale = index.centres, index.scale
    probes = min(cfg.probes, len(centres))
    if probes == 0:
        return queries.sparkSession.createDataFrame([], "query long, rank int, id long, distance double")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dims)
            near = _nearest(x, centres, probes) if len(x) else np.zeros((0, probes), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32())), batch.column("v")],
                names=["query", "cells", "v"],
            )

    asked = queries.select(F.col("query").cast("long"), F.col("v").cast("array<float>")).mapInArrow(
        probe, "query long, cells array<int>, v array<float>"
    )
    chunks = index.table.select("cell", "chunk").distinct()
    sent = asked.select("query", "v", F.explode("cells").alias("cell")).join(chunks, "cell")
    sides = sent.select("cell", "chunk", F.col("query").alias("id"), "v", F.lit(None).cast("binary").alias("code"),
                        F.lit(True).alias("asking")).unionByName(
        index.table.select("cell", "chunk", "id", F.lit(None).cast("array<float>").alias("v"), "code", F.lit(False).alias("asking"))
    )
    out = T.StructType(
        [T.StructField("query", T.LongType()), T.StructField("id", T.LongType()), T.StructField("approx", T.DoubleType())]
    )
    shortlist = cfg.shortlist

    def score(table: pa.Table) -> pa.Table:
        asking = table.column("asking").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy(zero_copy_only=False)
        cell = int(table.column("cell")[0].as_py())
        held = ~asking
        if not asking.any() or not held.any():
            return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "approx": pa.array([], pa.float64())})
        q = _matrix(table.filter(pa.array(asking)).column("v"), dims)
        codes = np.frombuffer(b"".join(table.filter(pa.array(held)).column("code").to_pylist()), np.int8)
        approx_x = centres[cell] + codes.reshape(-1, dims).astype(np.float64) * scale
        d = (q * q).sum(1)[:, None] - 2 * q @ approx_x.T + (approx_x * approx_x).sum(1)[None, :]
        keep = min(shortlist + 1, d.shape[1])
        best = np.argpartition(d, keep - 1, axis=1)[:, :keep]
        rows = np.repeat(np.arange(len(q)), keep)
        return pa.table({
            "query": pa.array(ids[asking][rows]),
            "id": pa.array(ids[held][best.ravel()]),
            "approx": pa.array(d[rows, best.ravel()]),
        })

    found = sides.groupBy("cell", "chunk").applyInArrow(score, out).filter(F.col("query") != F.col("id"))
    first = Window.partitionBy("query").orderBy("approx", "id")
    listed = found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= shortlist)
    vectors = index.table.select("id", F.col("v").alias("x"))
    exact = listed.join(vectors, "id").join(queries.select(F.col("query").cast("long"), "v"), "query")
    both = F.zip_with(F.col("x").cast("array<double>"), F.col("v").cast("array<double>"), lambda a, b: (a - b) * (a - b))
    # rounded, so that sums in another order give the same ranks
    distance = F.round(F.aggregate(both, F.lit(0.0), lambda s, t: s + t), 9)
    ranked = exact.select("query", "id", distance.alias("distance")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    )
    return ranked.filter(F.col("rank") <= cfg.k).select("query", F.col("rank").cast("int"), "id", "distance")
