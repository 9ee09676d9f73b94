"""Whole jobs: read, transform, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewlib import sources
from reviewlib.functions.patterns import LABELS, DumpFormat
from reviewlib.functions.text import clean_model_text, named
from reviewlib.operators import (
    classifier,
    evaluation,
    labeling,
    parse,
    prepare,
    profile,
    sequence,
    split,
    vocabulary,
)
from reviewlib.scratch import scratch_dir


def parse_job(
    spark: SparkSession,
    dumps: str,
    out: str,
    fmt: DumpFormat = DumpFormat(),
    source: str = "file",
    mode: str = "overwrite",
) -> None:
    """Dump files to a piped review table; a dump is a file or, by ``source``, a folder. Files are
    split over tasks, and the cut comments wait in the scratch folder while reviews are put
    together."""
    pieces = sources.read_dump_pieces(spark, dumps, fmt, source)
    table = scratch_dir(spark)
    parse.cut_comments(pieces, "source_file", block="block", fmt=fmt).write.parquet(table)
    reviews = parse.join_comments(spark.read.parquet(table), "source_file", fmt)
    sources.write_reviews(reviews, out, fmt, mode)


def preprocess_job(spark: SparkSession, reviews: str, out: str, mode: str = "overwrite") -> int:
    """Piped review table to a comma-separated one with cleaned columns and lengths. Returns
    the number of rows, counted while they are written."""
    df = sources.read_reviews(spark, reviews, error=KeyError)
    written = Observation()
    counted = prepare.preprocess_reviews(df).observe(written, F.count(F.lit(1)).alias("rows"))
    sources.write_csv(counted, out, mode=mode)
    return written.get["rows"]


def label_job(
    spark: SparkSession,
    reviews: str,
    out: str,
    strip_emojis: bool = True,
    ratings_from: str = "clean",
    mode: str = "overwrite",
) -> dict[str, int]:
    """Piped review table to a comma-separated labelled one. Returns ``rows_in``,
    ``rows_usable`` and the rows per label, counted while they are written."""
    rated = labeling.rate_reviews(
        sources.read_reviews(spark, reviews), strip_emojis, ratings_from
    )
    usable = labeling.usable()
    seen = Observation()
    counted = rated.observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(usable).alias("rows_usable"),
        *(F.count_if(usable & (F.col("label") == name)).alias(name) for name in LABELS),
    )
    sources.write_csv(counted.filter(usable), out, mode=mode)
    return seen.get


@dataclass(frozen=True)
class EdaReport:
    """Frames of the exploration report; each is computed when asked for."""

    rows: DataFrame
    null_counts: DataFrame
    describe: DataFrame
    rating_distribution: DataFrame
    words_histogram: DataFrame
    words_by_rating: DataFrame
    top_authors: DataFrame
    suspects: DataFrame
    duplicates: DataFrame


def eda_job(
    spark: SparkSession, folder: str, out: str, sep: str = "|", mode: str = "overwrite"
) -> EdaReport | None:
    """Explore every CSV of a folder and write the preview; ``None`` without any data.

    The files are parsed once: rows as read and their features go to a table in the
    session's scratch folder, and every report reads its own columns of it.
    """
    raw = sources.load_raw_reviews(spark, folder, sep)
    if not raw.columns:
        return None
    table = scratch_dir(spark)
    as_read = F.struct(*(named(c) for c in raw.columns)).alias("as_read")
    features = prepare.eda_features(raw.select("*", as_read))
    features.withColumn("row_id", F.monotonically_increasing_id()).write.parquet(table)
    df = spark.read.parquet(table)
    raw = df.select("as_read.*")
    sources.write_preview(df, out, mode)
    return EdaReport(
        rows=df.drop("row_id", "as_read"),
        null_counts=profile.null_counts(raw),
        describe=profile.describe(raw),
        rating_distribution=profile.rating_distribution(df),
        words_histogram=profile.histogram(df),
        words_by_rating=profile.box_statistics(df),
        top_authors=profile.top_authors(df),
        suspects=profile.suspect_reviews(df).orderBy("row_id").limit(10).drop("row_id", "as_read"),
        duplicates=profile.duplicate_messages(df)
        .orderBy("message", "row_id")
        .limit(20)
        .select("name", "rating", "message"),
    )


def split_and_clean(
    df: DataFrame, cfg: classifier.TrainConfig = classifier.TrainConfig()
) -> DataFrame:
    """Known labels only, model text, ``split`` column: (id, text, label, split)."""
    columns = [cfg.id_col, cfg.text_col, cfg.label_col]
    known = df.select(*columns).filter(F.col(cfg.text_col).isNotNull())
    sides = split.stratified_split(
        known, cfg.label_col, cfg.id_col, cfg.val_size, cfg.test_size, cfg.seed
    )
    return clean_model_text(sides, cfg.text_col)


def train_and_evaluate(
    df: DataFrame,
    cfg: classifier.TrainConfig = classifier.TrainConfig(),
    out: str | None = None,
) -> DataFrame:
    """Split, train, score the test side. One row: ``test_loss``, ``test_acc``,
    ``epochs_trained`` (solver iterations), ``class_weight`` (id to weight, null when
    off), ``labels``. With ``out`` the model goes to ``out/model`` and the row to
    ``out/metrics``.

    The cleaned and split rows are written once to the scratch folder, by side, since
    training passes over them many times.
    """
    spark = df.sparkSession
    table = scratch_dir(spark)
    split_and_clean(df, cfg).write.partitionBy("split").parquet(table)
    rows = spark.read.parquet(table)
    train, test = (rows.filter(F.col("split") == side) for side in ("train", "test"))

    model = classifier.train_classifier(train, cfg, cleaned=True, scratch=scratch_dir(spark))
    if out:
        sources.save_model(model, f"{out}/model")
    scored = classifier.predict_labels(model, test, cfg.text_col, cleaned=True)
    scores = evaluation.accuracy_and_loss(scored, cfg.label_col)

    iterations = model.stages[-1].summary.totalIterations
    if cfg.class_weight:
        weights = split.class_weights(train, cfg.label_col).agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col("label_id").cast("string"), "weight"))
            ).alias("w")
        )
        weight_map = weights.scalar()
    else:
        weight_map = F.lit(None).cast("map<string,double>")
    metrics = scores.select(
        "test_loss",
        "test_acc",
        F.lit(iterations).alias("epochs_trained"),
        weight_map.alias("class_weight"),
        F.lit(list(LABELS)).alias("labels"),
    )
    if not out:
        return metrics
    sources.write_metrics(metrics, f"{out}/metrics", "overwrite")
    return spark.read.schema(metrics.schema).json(f"{out}/metrics")


def train_and_evaluate_sequences(
    df: DataFrame,
    cfg: classifier.TrainConfig = classifier.TrainConfig(),
    seq: sequence.SequenceConfig = sequence.SequenceConfig(),
    seq_len: int = 200,
) -> DataFrame:
    """Split and clean as :func:`train_and_evaluate`, build the vocabulary of the training side,
    encode every text as ids, train the recurrent classifier with early stopping on the
    validation side, and score the test side. One row: ``epochs_trained``, ``best_epoch``,
    ``val_loss`` (of the kept weights), ``test_loss``, ``test_acc``, ``majority`` (share of the
    most common label on the test side), ``labels``."""
    spark = df.sparkSession
    table = scratch_dir(spark)
    split_and_clean(df, cfg).write.partitionBy("split").parquet(table)
    rows = spark.read.parquet(table).withColumnRenamed(cfg.id_col, "id")
    train_side = rows.filter(F.col("split") == "train")
    words = vocabulary.build_vocabulary(train_side, cfg.text_col, seq.num_words)
    encoded = vocabulary.encode_sequences(rows, words, "id", cfg.text_col, seq_len)
    weights = split.class_weights(train_side, cfg.label_col).select("label_id", "weight")
    labelled = (
        rows.select("id", "split", split.encode_label(cfg.label_col).alias("label_id"), cfg.label_col)
        .join(encoded, "id")
        .join(F.broadcast(weights), "label_id", "left")  # one row per label
    )
    encoded_table = scratch_dir(spark)
    labelled.write.partitionBy("split").parquet(encoded_table)
    labelled = spark.read.parquet(encoded_table)
    side = {s: labelled.filter(F.col("split") == s) for s in ("train", "val", "test")}
    model = sequence.train(side["train"], side["val"], scratch_dir(spark), seq)
    scored = sequence.predict_proba(model, side["test"].select("id", "ids", cfg.label_col))
    scored = scored.withColumn("pred", classifier.most_likely("p"))
    scores = evaluation.accuracy_and_loss(scored, cfg.label_col)
    counts = side["test"].groupBy(cfg.label_col).count()
    majority = counts.agg((F.max("count") / F.sum("count")).alias("majority"))
    return scores.join(majority, how="inner").select(
        F.lit(model.epochs_trained).alias("epochs_trained"),
        F.lit(model.best_epoch).alias("best_epoch"),
        F.lit(float(min(model.history)) if model.history else None).cast("double").alias("val_loss"),
        "test_loss",
        "test_acc",
        "majority",
        F.lit(list(LABELS)).alias("labels"),
    )


def train_job(
    spark: SparkSession,
    labeled: str,
    out: str,
    cfg: classifier.TrainConfig = classifier.TrainConfig(),
) -> DataFrame:
    """Train on a comma-separated labelled table. Rows without an id column get one, kept
    in the scratch folder so that every pass sees the same ids."""
    df = sources.read_labeled(spark, labeled, cfg.text_col, cfg.label_col)
    if cfg.id_col not in df.columns:
        table = scratch_dir(spark)
        df.withColumn(cfg.id_col, F.monotonically_increasing_id()).write.parquet(table)
        df = spark.read.parquet(table)
    return train_and_evaluate(df, cfg, out)


def evaluate_job(df: DataFrame, out: str, name: str, mode: str = "overwrite") -> DataFrame:
    """Metrics as JSON and the confusion matrix as CSV for a frame with ``label`` and
    ``pred``; returns the metrics."""
    metrics = evaluation.compute_metrics(df)
    sources.write_metrics(metrics, f"{out}/{name}_metrics", mode)
    sources.write_csv(
        evaluation.confusion_matrix(df), f"{out}/{name}_confusion_matrix", mode=mode
    )
    return df.sparkSession.read.schema(metrics.schema).json(f"{out}/{name}_metrics")
