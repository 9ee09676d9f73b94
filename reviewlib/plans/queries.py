"""The registered queries: each operator over the test tables, whole.

Queries that write and read back use a new folder in the session's scratch space.
Averages are rounded to nine places or six, since summing in another order changes the last ones.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlib import functions as R
from reviewlib import sources
from reviewlib.sources.pages import elements
from reviewlib.functions.patterns import LABELS, DumpFormat
from reviewlib.operators import (
    classifier,
    communities,
    dense,
    embeddings,
    evaluation,
    labeling,
    parse,
    prepare,
    profile,
    raters,
    sequence,
    similar_texts,
    similarity,
    split,
    stylometry,
    topics,
    vector_index,
    vocabulary,
)
from reviewlib.plans import jobs, views
from reviewlib.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# How many comments per source the registered flattening keeps.
FLATTEN_MAX = 30


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.REVIEWS)


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.COMMENTS)


def _mini_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.MINI_DUMPS)


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.SENTENCES)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.view(spark, sf_dir, views.PREDICTIONS)
    return rows.select("doc_id", "label", "pred", F.array(*_P).alias("p"))


_P = ("p_negative", "p_neutral", "p_positive")


def _eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.eda_features(_reviews(spark, sf_dir))


def _on_reviews(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    rows = _reviews(spark, sf_dir)
    return rows.select("review_id", *(c.alias(n) for n, c in columns.items()))


def _rounded(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# -- dumps -----------------------------------------------------------------------------


@query
def normalize_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mini_dumps(spark, sf_dir).select("doc_id", R.normalize_dump("dump").alias("dump"))


@query
def find_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _mini_dumps(spark, sf_dir).select("doc_id", R.normalize_dump("dump").alias("t"))
    found = text.select("doc_id", F.posexplode(parse.find_headers("t")).alias("header_no", "h"))
    return found.select("doc_id", "header_no", "h.name", "h.reviews", "h.photos")


@query
def extract_rating_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mini_dumps(spark, sf_dir).select(
        "doc_id", R.extract_rating_text("dump").alias("rating")
    )


@query
def clean_dump_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mini_dumps(spark, sf_dir).select(
        "doc_id", R.clean_dump_message(R.normalize_dump("dump")).alias("message")
    )


@query
def sanitize_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mini_dumps(spark, sf_dir).select("doc_id", R.sanitize_field("dump").alias("field"))


@query
def parse_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole dumps, one per document."""
    return parse.parse_dumps(_mini_dumps(spark, sf_dir))


@query
def parse_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump of each source, parsed without joining its comments."""
    return parse.parse_comments(_comments(spark, sf_dir), "source", "doc_id")


@query
def flatten_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = _comments(spark, sf_dir)
    return sources.dump_comments(comments, "source", "doc_id", "comment", FLATTEN_MAX)


@query
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", F.posexplode(sources.page_elements(F.col("html"), "ad")).alias("pos", "element")
    )


@query
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of every ``<article>`` of every page, headings and paragraphs inside included."""
    pages = views.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", F.posexplode(elements(F.col("html"), "article", None)).alias("pos", "element")
    )


def _dump_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark)
    sources.write_dumps(_comments(spark, sf_dir), path, "source", "doc_id", "comment")
    return path


def _source_of(file: str) -> Column:
    return F.regexp_extract(file, "source=([^/]+)", 1).alias("source")


@query
def dump_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps written to files, read back by folder, parsed."""
    files = f"{_dump_files(spark, sf_dir)}/*/*.txt"
    pieces = sources.read_dump_pieces(spark, files, source="folder")
    rows = parse.parse_comments(pieces, "source_file", block="block")
    return rows.select(_source_of("source_file"), *rows.columns[1:])


@query
def dump_file_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the cut comments kept in a table in between."""
    files = f"{_dump_files(spark, sf_dir)}/*/*.txt"
    pieces = sources.read_dump_pieces(spark, files, source="folder")
    cut = scratch_dir(spark)
    parse.cut_comments(pieces, "source_file", block="block").write.parquet(cut)
    rows = parse.join_comments(spark.read.parquet(cut), "source_file")
    return rows.select(_source_of("source_file"), *rows.columns[1:])


@query
def parse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark)
    jobs.parse_job(spark, f"{_dump_files(spark, sf_dir)}/*/*.txt", out, source="folder")
    return sources.read_reviews(spark, out)


@query
def parse_job_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse job over Latin-1 dumps, of comments that Latin-1 can hold."""
    comments, path, out = _comments(spark, sf_dir), scratch_dir(spark), scratch_dir(spark)
    flat = sources.dump_comments(comments, "source", "doc_id", "comment")
    # a string column can hold the bytes of any encoding, and the text writer writes them as they are
    encoded = F.encode(F.concat(F.lit(" "), "comment", F.lit(" ")), "ISO-8859-1").cast("string")
    spaced = flat.select("source", "doc_id", encoded.alias("value"))
    ordered = spaced.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    ordered.drop("doc_id").write.partitionBy("source").option("lineSep", "|").text(path)
    latin = DumpFormat(encoding="ISO-8859-1")
    jobs.parse_job(spark, f"{path}/*/*.txt", out, latin, source="folder")
    return sources.read_reviews(spark, out)


# -- cleaning --------------------------------------------------------------------------


@query
def basic_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, message=R.basic_clean("message"))


@query
def remove_emojis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, message=R.remove_emojis("message"))


@query
def clean_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(
        spark,
        sf_dir,
        message=R.clean_message("message"),
        with_emojis=R.clean_message("message", strip_emojis=False),
    )


@query
def clean_model_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.clean_model_text(_on_reviews(spark, sf_dir, message=F.col("message")), "message")


@query
def coerce_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(
        spark, sf_dir, rating_raw=F.col("rating"), rating=R.coerce_rating("rating")
    )


@query
def normalize_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, number_of_photos_norm=R.normalize_photos("number_of_photos"))


@query
def prepare_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_columns(_reviews(spark, sf_dir), "number_of_photos", "0")


@query
def preprocess_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.preprocess_reviews(_reviews(spark, sf_dir))


@query
def eda_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eda(spark, sf_dir)


# -- labels ----------------------------------------------------------------------------


@query
def parse_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, rating_num=R.parse_rating("rating"))


@query
def message_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _reviews(spark, sf_dir).select(
        "review_id", F.posexplode(R.message_ratings("message")).alias("pos", "value")
    )
    return found


@query
def message_rating_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, median=R.rating_median(R.message_ratings("message")))


@query
def rating_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(
        spark, sf_dir, rating_num=labeling.rating_number("rating", R.clean_message("message"))
    )


@query
def rating_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_reviews(spark, sf_dir, label=R.rating_label(R.parse_rating("rating")))


@query
def label_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_reviews(_reviews(spark, sf_dir))


@query
def label_reviews_raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_reviews(_reviews(spark, sf_dir), ratings_from="raw")


@query
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_distribution(label_reviews(spark, sf_dir))


@query
def labeling_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.labeling_summary(_reviews(spark, sf_dir))


# -- tables as files -------------------------------------------------------------------


def _review_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark)
    sources.write_reviews(_reviews(spark, sf_dir), path)
    return path


@query
def read_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_reviews(spark, _review_files(spark, sf_dir))


@query
def read_irregular_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A piped file where German records are short, French ones too long, and English ones
    have a quoted separator."""
    message = F.replace(R.flatten_comment("text"), F.lit('"'), F.lit('""'))
    quoted = F.concat(F.lit('"'), message, F.lit(' | fim"'))
    message = F.concat(F.lit('"'), message, F.lit('"'))
    lang, empty = F.col("lang"), (F.lit(""), F.lit(""))
    record = (
        F.when(lang == "en", F.concat_ws("|", "source", F.lit("4/5"), F.lit("NA"), quoted))
        .when(lang == "de", F.concat_ws("|", "source", F.lit("3/5")))
        .when(lang == "fr", F.concat_ws("|", "source", F.lit("1"), F.lit("2"), quoted, *empty))
        .otherwise(F.concat_ws("|", "source", F.lit("null"), F.lit(""), message))
    )
    path = scratch_dir(spark)
    records = views.table(spark, sf_dir, "documents").select(
        record.alias("name|rating|number_of_photos|message")
    )
    # one unquoted field per line: the records are written as they are
    records.write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    return sources.read_reviews(spark, path)


def _lines(records: Column, path: str, header: str, rows: DataFrame) -> None:
    """Adds files of ``records`` as they are under ``header``."""
    lines = rows.select(records.alias(header))
    lines.write.mode("append").option("header", True).option("quote", "").option("sep", "\x01").csv(path)


@query
def read_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files have their columns in different orders."""
    path, documents = scratch_dir(spark), views.table(spark, sf_dir, "documents")
    fields = {"name": F.col("source"), "rating": F.lit("4/5"), "number_of_photos": F.col("lang"),
              "message": F.replace(R.flatten_comment("text"), F.lit("|"), F.lit("/"))}
    for n, order in enumerate((list(fields), list(reversed(fields)))):
        part = documents.filter((F.col("doc_id") % 2) == n)
        message = F.replace(fields["message"], F.lit('"'), F.lit('""'))
        cells = [F.concat(F.lit('"'), message, F.lit('"')) if c == "message" else fields[c] for c in order]
        _lines(F.concat_ws("|", *cells), path, "|".join(order), part)
    return sources.read_reviews(spark, path).select(*fields)


@query
def read_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes inside unquoted fields are plain characters: they hide no separator, so every
    third record is too long and skipped."""
    path, documents = scratch_dir(spark), views.table(spark, sf_dir, "documents")
    short = F.concat_ws("|", F.concat(F.lit('a"'), "source"), F.lit("1"), F.lit("2"), F.lit('x"y'))
    record = F.when(F.col("doc_id") % 3 == 0, F.concat(short, F.lit('|more"|z'))).otherwise(short)
    _lines(record, path, "name|rating|number_of_photos|message", documents)
    return sources.read_reviews(spark, path)


@query
def load_raw_with_blank_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder in which one file has blank lines only: it is left out with a warning."""
    path, documents = scratch_dir(spark), views.table(spark, sf_dir, "documents")
    rows = documents.select(F.col("source").alias("name"), F.col("lang").alias("rating"))
    rows.write.option("header", True).csv(path)
    blank = documents.limit(1).select(F.lit("  ").alias("value"))
    # a CSV file without a header or a visible character, since only *.csv files are loaded
    blank.write.mode("append").option("quote", "").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return sources.load_raw_reviews(spark, path).drop("__source_file")


@query
def load_raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files in UTF-8 with commas, Latin-1 with commas, UTF-8 with semicolons."""
    path = scratch_dir(spark)
    documents = views.table(spark, sf_dir, "documents")
    rows = documents.select(
        F.col("source").alias("name"),
        F.col("lang").alias("rating"),
        F.concat("text", F.lit(", é")).alias("message"),
        F.col("n_chars").cast("string").alias("chars"),
    )

    def write(df: DataFrame, sep: str, encoding: str) -> None:
        df.write.mode("append").option("header", True).option("sep", sep).option(
            "escape", '"'
        ).option("encoding", encoding).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(path)

    lang = F.col("rating")
    write(rows.filter(lang == "fr"), ",", "ISO-8859-1")
    write(rows.filter(lang == "es").drop("chars"), ";", "UTF-8")
    write(rows.filter(~lang.isin("fr", "es")), ",", "UTF-8")
    found = sources.load_raw_reviews(spark, path)
    return found.select(
        "name", "rating", "message", "chars", F.col("__source_file").like("part-%").alias("named")
    )


@query
def read_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Latin-1 table, asked for as UTF-8."""
    path = scratch_dir(spark)
    rows = views.table(spark, sf_dir, "documents").select("source", "lang", "text")
    rows.write.option("header", True).option("escape", '"').option(
        "encoding", "ISO-8859-1"
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return sources.read_with_fallback(spark, path)


@query
def eda_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploration job over a folder of piped files; the preview it writes."""
    out = scratch_dir(spark)
    jobs.eda_job(spark, _review_files(spark, sf_dir), out)
    return sources.read_labeled(spark, out, "message", "name")


@query
def read_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table written with commas and read for training."""
    path = scratch_dir(spark)
    sources.write_csv(label_reviews(spark, sf_dir), path)
    return sources.read_labeled(spark, path)


@query
def preprocess_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark)
    jobs.preprocess_job(spark, _review_files(spark, sf_dir), out)
    return sources.read_labeled(spark, out, "message_clean", "rating_clean")


@query
def label_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark)
    jobs.label_job(spark, _review_files(spark, sf_dir), out)
    return sources.read_labeled(spark, out)


@query
def write_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark)
    sources.write_preview(_eda(spark, sf_dir), out)
    return sources.read_labeled(spark, out, "message", "name")


# -- reports ---------------------------------------------------------------------------


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(_reviews(spark, sf_dir))


@query
def describe_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eda(spark, sf_dir).select("name", "rating", "number_of_photos", "message", "len_words")
    return _rounded(profile.describe(rows), "mean", "std", "q25", "q50", "q75", places=6)


@query
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rating_distribution(_eda(spark, sf_dir))


@query
def words_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.histogram(_eda(spark, sf_dir)), "low", "high")


@query
def words_box_by_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.box_statistics(_eda(spark, sf_dir)), "q1", "median", "q3")


@query
def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_authors(_eda(spark, sf_dir))


@query
def suspect_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.suspect_reviews(_eda(spark, sf_dir)).select(
        "review_id", "name", "rating", "len_words", "has_url", "message"
    )


@query
def suspect_reviews_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suspect_reviews(spark, sf_dir).orderBy("review_id").limit(10)


@query
def duplicate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_messages(_eda(spark, sf_dir)).select(
        "review_id", "name", "rating", "message"
    )


@query
def duplicate_messages_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_messages(spark, sf_dir).orderBy("message", "review_id").limit(20)


# -- training --------------------------------------------------------------------------


@query
def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = _sentences(spark, sf_dir).select(
        "doc_id", "label", split.encode_label("label").alias("label_id")
    )
    return coded.withColumn("decoded", split.decode_label("label_id"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(_sentences(spark, sf_dir), "label", "doc_id")


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("doc_id", "label", "split")


@query
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows in shuffled order: their places, as they are read back from ordered files, and
    the key they are ordered by."""
    path = scratch_dir(spark)
    rows = split.shuffle_rows(_sentences(spark, sf_dir), "doc_id")
    rows.select("doc_id", split.shuffle_key("doc_id").alias("key")).write.parquet(path)
    stored = spark.read.parquet(path)
    place = stored.select(
        "doc_id", "key", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    sizes = place.groupBy("file").agg(F.count("*").alias("n"))
    # a row per file: as many as there are shuffle partitions
    before = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return place.join(first, "file").select("doc_id", "key", (F.col("first") + F.col("row")).alias("position"))


@query
def split_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _sentences(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    return split.split_quotas(counts)


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split(spark, sf_dir).filter(F.col("split") == "train")
    return _rounded(split.class_weights(train), "weight")


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.build_vocabulary(_split(spark, sf_dir).filter(F.col("split") == "train"))


@query
def build_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir)


@query
def encode_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = vocabulary.encode_sequences(
        _sentences(spark, sf_dir), _vocabulary(spark, sf_dir), "doc_id"
    )
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", ids.alias("ids"))


@cache
def _model_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark)
    table = scratch_dir(spark)
    jobs.split_and_clean(_sentences(spark, sf_dir), _CONFIG).write.partitionBy("split").parquet(
        table
    )
    train = spark.read.parquet(table).filter(F.col("split") == "train")
    sources.save_model(classifier.train_classifier(train, _CONFIG, cleaned=True), path)
    return path


_CONFIG = classifier.TrainConfig(id_col="doc_id", max_iter=10)


@query
def train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows and weight of each class, and whether the saved model came back whole: a finite
    intercept for each class, and coefficients for all words of the vocabulary."""
    model = sources.load_model(_model_path(spark, sf_dir))
    fitted, words = model.stages[-1], len(model.stages[1].vocabulary)
    finite = [math.isfinite(x) for x in fitted.interceptVector.toArray()]
    train = _split(spark, sf_dir).filter(F.col("split") == "train")
    weights = _rounded(split.class_weights(train), "weight")
    return weights.select(
        "label",
        "n",
        "weight",
        F.get(F.lit(finite), F.col("label_id")).alias("finite_intercept"),
        F.lit(fitted.numFeatures == words).alias("all_words_used"),
    )


@query
def predict_proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row: are the probabilities one per class, in 0..1, with sum 1."""
    model = sources.load_model(_model_path(spark, sf_dir))
    scored = classifier.predict_proba(model, _sentences(spark, sf_dir))
    total = F.aggregate("p", F.lit(0.0), lambda t, x: t + x)
    return scored.select(
        "doc_id",
        "label",
        F.size("p").alias("classes"),
        F.forall("p", lambda x: x.between(0, 1)).alias("in_range"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
    )


@query
def predict_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row: is the predicted label a known one, that of the largest probability."""
    model = sources.load_model(_model_path(spark, sf_dir))
    scored = classifier.predict_labels(model, _sentences(spark, sf_dir))
    own = F.get("p", F.array_position(F.lit(list(LABELS)), F.col("pred")).cast("int") - 1)
    return scored.select("doc_id", "label", (own == F.array_max("p")).alias("pred_is_argmax"))


@query
def most_likely_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir).select(
        "doc_id", classifier.most_likely("p").alias("most_likely")
    )


@query
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained, scored, and the metrics document read back: labels, weights, and whether the scores
    are what they must be at least."""
    out = scratch_dir(spark)
    jobs.train_and_evaluate(_sentences(spark, sf_dir), _CONFIG, out)
    metrics = spark.read.schema(_METRICS).json(f"{out}/metrics")
    test = _split(spark, sf_dir).filter(F.col("split") == "test").groupBy("label").count()
    majority = test.agg((F.max("count") / F.sum("count")).alias("share"))
    weights = [F.round(F.col("class_weight")[str(i)], 9).alias(f"w_{c}") for i, c in enumerate(LABELS)]
    return metrics.select(
        F.array_join("labels", " ").alias("labels"),
        *weights,
        (F.col("epochs_trained").between(1, _CONFIG.max_iter)).alias("epochs_in_range"),
        (F.col("test_loss").between(0, 20)).alias("loss_finite"),
        # where all classes weigh alike, rare ones may cost the frequent one a few rows
        (F.col("test_acc") >= majority.scalar() - 0.1).alias("accuracy_near_majority_or_above"),
    )


SIMILAR = 0.8


@query
def similar_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of reviews whose TF-IDF cosine is at least 0.8: the review similarity graph."""
    classes = similar_texts.similar_classes(_reviews(spark, sf_dir), "review_id", "message", SIMILAR)
    return similarity.expanded(*classes, SIMILAR)


@query
def similar_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of authors (names trimmed, in lower case) whose reviews, counted together, have a
    TF-IDF cosine of at least 0.8: the author similarity graph."""
    reviews = _reviews(spark, sf_dir).select(F.lower(R.strip("name")).alias("author"), "message")
    vectors = similarity.tfidf(similarity.term_counts(reviews, "author", "message"))
    return similarity.similar_pairs(vectors, SIMILAR)


@query
def review_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communities of the review similarity graph (cosine as weight) by modularity moves: every
    review with a link, and the least review of its community."""
    members, pairs = similar_texts.similar_classes(_reviews(spark, sf_dir), "review_id", "message", SIMILAR)
    edges = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("cosine").alias("w"))
    found = communities.louvain(edges, members=members.select(F.col("id").alias("node"), F.col("rep").alias("cls")))
    return found.select(F.col("node").alias("review_id"), "community")


@query
def word_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of the 5,000 most frequent review words, from positive PMI of words at most two
    apart and block power iteration; dimensions ordered by singular value, which come beside."""
    values, vectors = embeddings.word_vectors(_reviews(spark, sf_dir), "review_id", "message")
    return vectors.select("token", "vector", F.lit([float(v) for v in values]).alias("singular_values"))


@query
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings (squared distance) of every embedding whose id is a multiple of
    100, among all, by an inverted-file index with exact re-ranking."""
    rows = views.table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull())
    vectors = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    dims = len(vectors.select("v").first()["v"]) if vectors.take(1) else 0
    index = vector_index.build(vectors, dims)
    queries = vectors.filter(F.col("id") % 100 == 0).select(F.col("id").alias("query"), "v")
    return vector_index.search(index, queries, dims)


@query
def grouped_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled reviews split with every author (name trimmed, lower case) on one side: per side
    and label the rows and authors, and how many authors are on more than one side (none)."""
    reviews = _reviews(spark, sf_dir).select("review_id", F.lower(R.strip("name")).alias("author"))
    rows = _sentences(spark, sf_dir).join(reviews, F.col("doc_id") == F.col("review_id")).drop("review_id")
    found = split.grouped_split(rows, "author", "label", "doc_id")
    sides = found.groupBy("author").agg(F.countDistinct("split").alias("sides"))
    spread = sides.filter((F.col("sides") > 1) & F.col("author").isNotNull()).count()
    return found.groupBy("split", "label").agg(
        F.count("*").alias("rows"), F.countDistinct("author").alias("authors")
    ).withColumn("authors_on_two_sides", F.lit(spread))


@query
def review_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Burrows' delta of every review with words against its author's function-word profile
    without it (authors: names trimmed, lower case)."""
    reviews = _reviews(spark, sf_dir).withColumn("author", F.lower(R.strip("name")))
    return stylometry.leave_one_out(stylometry.review_counts(reviews, "review_id", "author", "message"))


@query
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of three noisy raters (the rating cell, the ratings in the message, the model's
    prediction) reconciled by expectation-maximisation: per review the likeliest label, its
    probability, the cell's label and its probability (low: a noisy cell label, to check first)."""
    reviews = _reviews(spark, sf_dir)
    cell = R.rating_label(R.parse_rating("rating"))
    message = R.rating_label(R.rating_median(R.message_ratings("message")))
    observed = reviews.select(
        F.col("review_id").alias("item"),
        F.inline(F.array(
            F.struct(F.lit("cell").alias("rater"), cell.alias("label")),
            F.struct(F.lit("message").alias("rater"), message.alias("label")),
        )),
    ).unionByName(_predictions(spark, sf_dir).select(
        F.col("doc_id").alias("item"), F.lit("model").alias("rater"), F.col("pred").alias("label")
    ))
    posterior, _, _ = raters.reconcile(observed)
    cells = reviews.select(F.col("review_id").alias("item"), cell.alias("cell_label"))
    best = F.array_position("p", F.array_max("p")).cast("int")
    return posterior.join(cells, "item", "left").select(
        F.col("item").alias("review_id"),
        F.element_at(F.lit(list(LABELS)), best).alias("label"),
        F.round(F.array_max("p"), 9).alias("p_label"),
        "cell_label",
        F.round(F.element_at("p", F.array_position(F.lit(list(LABELS)), F.col("cell_label")).cast("int")), 9).alias("p_cell"),
    )


@query
def spam_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors in the densest part of the graph of authors and the messages they wrote (messages
    by SHA-256 of their trimmed text): the round each author was peeled in, whether it is in
    the densest set, and that set's density."""
    reviews = _reviews(spark, sf_dir)
    text = R.strip("message")
    edges = reviews.filter(F.col("name").isNotNull() & text.isNotNull() & (text != "")).select(
        F.concat(F.lit("a:"), F.lower(R.strip("name"))).alias("src"),
        F.concat(F.lit("m:"), F.sha2(text, 256)).alias("dst"),
    )
    found, density = dense.peel(edges)
    return found.filter(F.col("node").startswith("a:")).select(
        F.substring("node", 3, 1 << 30).alias("author"), "round", "dense", F.lit(density).alias("density")
    )


@query
def review_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic labels of reviews: counts of the 2,000 most frequent words factorised into 8 topics
    by multiplicative updates; each review's topic of largest weight, that weight, and the
    topic's five heaviest words."""
    cfg = topics.TopicConfig()
    words, matrix = topics.term_matrix(_reviews(spark, sf_dir), "review_id", "message", cfg.num_words)
    n = words.count()
    if n == 0:
        return spark.createDataFrame([], "review_id long, topic int, weight double, top_words array<string>")
    w, h, _ = topics.factorise(matrix, n, cfg)
    names = dict((r["t"], r["token"]) for r in words.collect())  # at most num_words rows
    heads = [[names[t] for t in np.argsort(-h[j], kind="stable")[:5]] for j in range(cfg.k)]
    best = (F.array_position("w", F.array_max("w")) - 1).cast("int")
    return w.select(
        F.col("d").alias("review_id"),
        best.alias("topic"),
        F.round(F.array_max("w"), 6).alias("weight"),
        F.get(F.lit(heads), best).alias("top_words"),
    )


_SEQUENCE = sequence.SequenceConfig()


@query
def train_sequence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recurrent classifier trained with early stopping: epochs, losses, test accuracy and
    the share of the most common test label beside it."""
    return jobs.train_and_evaluate_sequences(_sentences(spark, sf_dir), _CONFIG, _SEQUENCE)


_METRICS = (
    "test_loss double, test_acc double, epochs_trained int, class_weight map<string,double>, "
    "labels array<string>"
)


# -- scores ----------------------------------------------------------------------------


@query
def eval_accuracy_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = evaluation.accuracy_and_loss(_predictions(spark, sf_dir))
    return _rounded(scores, "test_acc", "test_loss")


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_predictions(spark, sf_dir))


@query
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluation.classification_report(_predictions(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluation.compute_metrics(_predictions(spark, sf_dir))
    return _rounded(metrics, "accuracy", "macro_f1", "weighted_f1")


@query
def evaluate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document of the evaluation job, beside its confusion matrix."""
    out = scratch_dir(spark)
    metrics = jobs.evaluate_job(_predictions(spark, sf_dir), out, "run")
    matrix = spark.read.option("header", True).csv(f"{out}/run_confusion_matrix")
    cells = [F.col(f"pred_{c}").cast("long").alias(f"pred_{c}") for c in LABELS]
    both = matrix.select("label", *cells).withColumn("accuracy", metrics.select("accuracy").scalar())
    return _rounded(both, "accuracy")


def _report(spark: SparkSession, sf_dir: str) -> jobs.EdaReport:
    """The reports of the exploration job over a folder of piped files."""
    return jobs.eda_job(spark, _review_files(spark, sf_dir), scratch_dir(spark))


@query
def eda_report_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).null_counts


@query
def eda_report_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).rating_distribution


@query
def eda_report_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).top_authors
