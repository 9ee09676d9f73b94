"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlib.llm import (
    decontamination,
    histogram_shards,
    language_id,
    licenses,
    merkle,
    neighbours,
    ngram_jaccard,
    outliers,
    pieces,
    quality,
    secret_automata,
    simhash,
    spelling,
    token_files,
)
from reviewlib.llm.common import id_and_text, scratch, stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every document."""
    return ngram_jaccard.similar_documents(table(spark, sf_dir, "documents"))


ORACLES["op1_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, m.b), d.doc_id) AS component_id
FROM documents AS d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) AS m USING (doc_id)
"""


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as files and read back: place, length and checksum of each."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    path = scratch(spark)
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    found = token_files.read(spark, path, packed=True)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as counts of the fixed kinds and spans."""
    docs = id_and_text(table(spark, sf_dir, "documents"))
    found = secret_automata.find(docs, secret_automata.learn(docs))
    base = F.filter("secrets", lambda s: s["kind"] != secret_automata.LEARNED)
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_automata.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_automata.joined(base), 256).alias("base_sha256"),
        secret_automata.joined(F.col("secrets")).alias("spans"),
    )


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item: ``doc_id``, ``item_id``, ``n_item``, ``n_common``."""
    return decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


ORACLES["op4_benchmark_decontamination"] = r"""
WITH w AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')
  FROM benchmark WHERE item_id IS NOT NULL
), sizes AS (
  SELECT DISTINCT least(5, len(w)) AS k FROM w WHERE kind = 1 AND len(w) > 0
), items AS (
  SELECT DISTINCT id AS item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
        FROM w WHERE kind = 1 AND len(w) > 0)
), docs AS (
  SELECT DISTINCT id AS doc_id, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, sizes WHERE kind = 0)
), n AS (SELECT item_id, count(DISTINCT s) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_common
FROM docs JOIN (SELECT DISTINCT item_id, s FROM items) USING (s) JOIN n USING (item_id)
GROUP BY ALL HAVING 100 * count(*) >= 80 * n_item
"""


@query
def op5_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return histogram_shards.shard(table(spark, sf_dir, "documents"))


@query
def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return outliers.judge(table(spark, sf_dir, "documents"))


def _fold(n: int) -> Column:
    """The part of ``n`` that a document is in, by its id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; those of fold 1 of 3 are held out of learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(_fold(3) != 1))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document as digests, and a checksum of the pieces' ends."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    found = pieces.encode(id_and_text(table(spark, sf_dir, "documents")), model)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.crc32(F.array_join(F.col("ends").cast("array<string>"), ",")).alias("ends_crc32"),
    )


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; those of fold 0 of 5 are held out of learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.filter(_fold(5) != 0))
    found = quality.score(docs, model)
    return found.select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest, licence and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of it edited: its second half replaced by the start of the
    next document (descending ``doc_id``, cyclic); their likeness, and how many documents lie
    within the search radius of its fingerprint (``n_near``, copies included, itself not)."""
    docs = id_and_text(table(spark, sf_dir, "documents"))
    order = [F.col("doc_id").isNull(), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)), F.xxhash64("text")]
    rows = neighbours.with_next(docs, order, ["text"])
    n = F.coalesce(F.char_length("text"), F.lit(0))
    half = F.floor(n / 2).cast("int")
    body, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    edited = F.concat(F.substring(body, 1, n - half), F.substring(following, 1, half))
    made = simhash.add_fingerprints(
        rows.select(
            "doc_id",
            n.cast("long").alias("n_chars"),
            F.sha2(edited, 256).alias("edited_sha256"),
            simhash.word_hashes(F.col("text")).alias("_t"),
            simhash.word_hashes(edited).alias("_e"),
            simhash.word_hashes(F.col("next_text")).alias("_n"),
        ),
        {"fp": "_t", "edited_fp": "_e", "next_fp": "_n"},
    )
    found = stored(made)
    near = simhash.within(found.select("fp"))
    return found.join(near, "fp").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.hex64(F.col("fp")).alias("fingerprint"),
        simhash.hex64(F.col("edited_fp")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        (F.col("n_near") + F.col("n") - 1).alias("n_near"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least 7 code points seen at least twice, their near words (one edit), the
    form they are a variant of (a near word seen ten times as often) and the root of forms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = docs.select("doc_id", F.explode(spelling.run_words(F.col("text"))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    n = F.char_length("run")
    cut = (h % n).cast("int")
    word = F.when(h % 31 == 0, F.concat(F.substring("run", 1, cut), F.substring("run", cut + 2, n))).otherwise(
        F.col("run")
    )
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= 7)
    vocabulary = stored(words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= 2))
    near = spelling.near_words(vocabulary)
    forms = stored(
        near.select(
            "word",
            "n",
            "n_near",
            F.when(F.col("best_n") >= 10 * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= 10 * F.col("n"), F.col("best_n")).alias("form_n"),
        )
    )
    return forms.join(spelling.roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot (per source), root and proof digest of every document; documents whose
    decimal id has an even unsigned crc32 lose the line feeds of their text, and are folded
    through their original proof, which verifies only if that changed nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(tampered, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    changed = docs.withColumn("tampered_leaf", merkle.leaf(*(F.col(f) for f in fields[:-1]), text))
    found = merkle.manifest(changed, "source", ["doc_id"], fields, carry=["doc_id", "tampered_leaf"])
    folded = merkle.fold(F.col("tampered_leaf"), F.col("proof"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
