"""Parsing, preprocessing and labelling look at one row at a time, so the batch transforms
run unchanged on a streaming frame. These take the files that have arrived since the
last run, exactly once, and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlib.functions.patterns import REVIEW_COLUMNS, DumpFormat
from reviewlib.operators.labeling import label_reviews
from reviewlib.operators.parse import parse_dumps
from reviewlib.operators.prepare import preprocess_reviews

_REVIEW_SCHEMA = ", ".join(f"{c} STRING" for c in REVIEW_COLUMNS)


def _run(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def parse_stream(
    spark: SparkSession,
    dumps: str,
    out: str,
    checkpoint: str,
    fmt: DumpFormat = DumpFormat(),
) -> StreamingQuery:
    """New dump files in ``dumps`` to review rows in ``out``."""
    files = spark.readStream.text(dumps, wholetext=True)
    texts = files.select(
        F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("dump")
    )
    return _run(parse_dumps(texts, fmt=fmt), out, checkpoint)


def _review_stream(
    spark: SparkSession,
    reviews: str,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    rows = spark.readStream.schema(_REVIEW_SCHEMA).parquet(reviews)
    return _run(transform(rows), out, checkpoint)


def preprocess_stream(
    spark: SparkSession, reviews: str, out: str, checkpoint: str
) -> StreamingQuery:
    """New review rows (as :func:`parse_stream` writes them) to cleaned columns."""
    return _review_stream(spark, reviews, out, checkpoint, preprocess_reviews)


def label_stream(spark: SparkSession, reviews: str, out: str, checkpoint: str) -> StreamingQuery:
    """New review rows to labelled ones."""
    return _review_stream(spark, reviews, out, checkpoint, label_reviews)
