"""From raw documents to token ids: filter, deduplicate, decontaminate, redact, encode.

Every stage works on all documents that the one before kept, and all but the last return the
columns of their input. Between stages documents are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlib.llm import decontamination, ngram_jaccard, pieces, quality, secret_automata
from reviewlib.llm.common import stored, table

MODEL = "piece_bpe_32k.model"


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose ``doc_id`` is in ``ids``; a null id is in none."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    own = _free_name(docs, "_score")
    scored = quality.score(docs, model, out=own)
    return scored.filter(F.col(own) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays. Rows that repeat
    an id are one document."""
    found = ngram_jaccard.similar_documents(docs)
    return _without(docs, found.filter("doc_id != component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return _without(docs, decontamination.contained_items(docs, table(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; ``n_chars`` follows the text."""
    clean = secret_automata.redact(docs, secret_automata.learn(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the ``ids`` and byte spans of each document's pieces."""
    with open(public_tokenizers.path(MODEL), "rb") as file:
        encoded = pieces.encode(docs.select("doc_id", "text"), file.read())
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends"
    )


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# A trained classifier and a learned format cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
