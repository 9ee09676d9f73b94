"""Similarity graphs: all pairs of TF-IDF vectors whose cosine reaches a threshold.

Vectors are rows (``id``, ``term``, ``w``), unit length per id. The join is exact and never pairs
all vectors. Equal vectors (weights rounded to ``SAME`` decimals, compared by two 64-bit hashes
and their number of terms) form a class, and only the least id of a class is searched: copies are
never paired until :func:`similar_pairs` gives them all out, and that step shuffles members only.

Between representatives, terms are ordered by document frequency, rare first, in levels of equal frequency;
terms of one vector are left out, since they add to no cosine. A vector's reach at a level is what its terms from that
level on can add to any cosine: their length, and their weights times the largest weight of each term
anywhere. Only entries whose reach is at least the threshold less ``SLACK`` are indexed, and a match of two of
them counts only if the product of both lengths is, too. All of a pair's matches from some level on
are left out, then, and add less than the threshold less ``SLACK``; so a pair is a candidate only if the
matches that count add up to ``SLACK``. Reaches come from sums per (vector, level), so a vector with very many terms
is not one task. A term with
more than ``HOT`` vectors is split: its index entries are dealt over buckets by id and the asking
entries copied to every bucket, so no task holds more than about ``HOT`` entries of one term.

Candidates are scored exactly in blocks: ids fall into blocks by hash, terms into groups, and a
task gets, for two blocks and a group, those parts of vectors that some candidate needs, each once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.functions.patterns import PUNCTUATION
from reviewlib.scratch import scratch_dir

HOT = 10_000
# Cosines are compared and given rounded to this many decimals, so that sums in another order agree.
DIGITS = 9
# Weights are rounded to this many decimals to find equal vectors.
SAME = 11
# How much of the cosine a candidate must have from its rare terms.
SLACK = 0.05
# Ids of a block and terms of one vector in a group that a scoring task takes, about.
_BLOCK, _GROUP = 512, 4096
# Bytes of text that a task cuts into words and counts at a time, about.
_SLICE = 1 << 23
# Members of a class that one bucket of its expansion takes, about.
_MEMBERS = 1_000
# Pairs that a task gives out, about.
_PAIRS = 4_000_000


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def term_counts(df: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``term``, ``tf``: words of the text by the vocabulary's rule, counted. Rows with a
    null id or no words give nothing.

    Tasks split the texts at white space and count, and apply the rest of the rule, which works
    character by character, to each different word of some megabytes once."""
    rows = df.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    out = T.StructType([rows.schema["id"], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            lo = 0
            while lo < len(ends):
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + _SLICE)))
                part = batch.slice(lo, hi - lo)
                lo = hi
                words = pc.ascii_split_whitespace(part.column(1).cast(pa.large_string()))
                each = words.flatten().dictionary_encode()
                own = part.column(0).dictionary_encode()
                of = np.repeat(
                    own.indices.to_numpy().astype(np.int64),
                    pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False),
                )
                wide = max(1, len(each.dictionary))
                codes, n = np.unique(of * wide + each.indices.to_numpy(), return_counts=True)
                bare = pc.replace_substring_regex(pc.ascii_lower(each.dictionary), PUNCTUATION, "")
                term = bare.take(pa.array(codes % wide)).cast(pa.string())
                found = pa.RecordBatch.from_arrays(
                    [own.dictionary.take(pa.array(codes // wide)), term, pa.array(n.astype(np.int64))], names=out.names
                )
                yield found.filter(pc.not_equal(term, ""))

    return rows.mapInArrow(run, out).groupBy("id", "term").agg(F.sum("tf").alias("tf"))


def tfidf(counts: DataFrame) -> DataFrame:
    """``id``, ``term``, ``w``: ``tf * (ln((n + 1) / (df + 1)) + 1)``, scaled to unit length per
    id; ``n`` counts ids with a term, ``df`` ids with the term. The counts are written once to the
    scratch folder, since three steps read them."""
    counts = _stored(counts)
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    total = counts.select(F.countDistinct("id")).first()[0]
    raw = counts.join(df, "term").select("id", "term", (F.col("tf") * (F.log((F.lit(total) + 1) / (F.col("df") + 1)) + 1)).alias("raw"))
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norm, "id").select("id", "term", (F.col("raw") / F.col("norm")).alias("w"))


def _members(vectors: DataFrame) -> DataFrame:
    """``id`` and ``rep``, the least id with the same vector."""
    w = F.round("w", SAME)
    marks = vectors.groupBy("id").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("term", w)).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "term", w)).alias("y"),
    )
    return classes_of(marks)


def classes_of(marks: DataFrame, *carry: str) -> DataFrame:
    """``id``, ``rep`` and the columns ``carry`` of rows whose marks ``n``, ``x`` and ``y`` are equal for equal vectors."""
    least = marks.groupBy("n", "x", "y").agg(F.min("id").alias("rep"))
    return marks.join(least, ["n", "x", "y"]).select("id", "rep", *carry)


def _candidates(placed: DataFrame, least: float, hot: int) -> DataFrame:
    """``a``, ``b`` (``a < b``): every pair of ``placed`` (``id``, ``tid``, ``w``, ``df``, ``top``)
    that can reach ``least``, and some that do not."""
    levels = placed.groupBy("id", "df").agg(
        F.sum(F.col("w") * F.col("w")).alias("s2"), F.sum(F.col("w") * F.col("top")).alias("st")
    )
    # running sums from the most frequent level down; a frame to the end would be summed anew for each row
    tail = Window.partitionBy("id").orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = levels.select("id", "df", F.sqrt(F.sum("s2").over(tail)).alias("l2"), F.sum("st").over(tail).alias("most"))
    rest = least - SLACK
    reach = reach.filter((F.col("l2") >= rest) & (F.col("most") >= rest)).drop("most")
    prefix = placed.select("id", "df", "tid", "w").join(reach, ["id", "df"])
    buckets = F.greatest(F.lit(1), F.ceil(F.col("df") / hot)).cast("int")
    index = prefix.select(
        "tid", F.col("id").alias("b"), F.col("l2").alias("l2b"), F.col("w").alias("wb"),
        F.pmod(F.xxhash64("id"), buckets).cast("int").alias("bucket"),
    )
    asked = prefix.select("tid", F.col("id").alias("a"), "l2", "w", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"))
    met = asked.join(index, ["tid", "bucket"]).filter((F.col("a") < F.col("b")) & (F.col("l2") * F.col("l2b") >= rest))
    found = met.groupBy("a", "b").agg(F.sum(F.col("w") * F.col("wb")).alias("found"))
    return found.filter(F.col("found") >= SLACK - 10.0**-DIGITS).select("a", "b")


def _dots(placed: DataFrame, candidates: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``dot`` of the ``candidates``, from the whole vectors of ``placed``."""
    kind = placed.schema["id"].dataType
    ids = candidates.select(F.col("a").alias("id")).union(candidates.select("b")).distinct()
    blocks = max(1, ceil(ids.count() / _BLOCK))
    longest = placed.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    groups = max(1, ceil(longest / _GROUP))
    block = {c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int") for c in ("a", "b")}
    keyed = candidates.select("a", "b", block["a"].alias("ba"), block["b"].alias("bb"))
    # other names than those of keyed, with which its groups meet
    to = (F.col("ba").alias("to_a"), F.col("bb").alias("to_b"))
    needed = keyed.select(F.col("a").alias("id"), *to).union(keyed.select("b", *to)).distinct()
    parts = (
        placed.join(ids, "id", "left_semi")
        .groupBy("id", F.pmod(F.xxhash64("tid"), F.lit(groups)).cast("int").alias("of"))
        .agg(F.sort_array(F.collect_list(F.struct("tid", "w"))).alias("v"))
        .select("id", "of", F.col("v.tid").alias("tids"), F.col("v.w").alias("ws"))
    )
    sent = parts.join(needed, "id").groupBy("to_a", "to_b", "of")
    asked = keyed.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")).groupBy("ba", "bb", "g")
    out = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("dot", T.DoubleType())])

    def score(vectors: pa.Table, pairs: pa.Table) -> pa.Table:
        vectors = vectors.combine_chunks()
        at = {v: i for i, v in enumerate(vectors.column("id").to_pylist())}
        tids, ws = [], []
        for name, into in (("tids", tids), ("ws", ws)):
            for chunk in vectors.column(name).chunks:
                flat, ends = chunk.flatten().to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
                into.extend(flat[lo:hi] for lo, hi in zip(ends[:-1] - ends[0], ends[1:] - ends[0]))
        dots = np.zeros(pairs.num_rows)
        for i, (a, b) in enumerate(zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist())):
            x, y = at.get(a), at.get(b)
            if x is None or y is None:
                continue  # no term of this group
            if len(tids[x]) > len(tids[y]):
                x, y = y, x
            to = np.minimum(np.searchsorted(tids[y], tids[x]), len(tids[y]) - 1)
            dots[i] = (ws[x] * ws[y][to] * (tids[y][to] == tids[x])).sum()
        return pa.Table.from_arrays([pairs.column("a"), pairs.column("b"), pa.array(dots)], names=out.names)

    return sent.cogroup(asked).applyInArrow(score, out).groupBy("a", "b").agg(F.sum("dot").alias("dot"))


def similar_classes(vectors: DataFrame, threshold: float = 0.8, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The members (``id``, ``rep``: the least id with the same vector) of every class of equal
    ``vectors``, and ``a``, ``b`` (representatives, ``a < b``), ``cosine`` of those classes whose rounded
    cosine is at least ``threshold``. Members of a class have cosine 1 with each other."""
    vectors = _stored(vectors.select("id", "term", "w"))
    members = _stored(_members(vectors))
    kept = vectors.join(members.filter(F.col("id") == F.col("rep")).select("id"), "id", "left_semi")
    terms = kept.groupBy("term").agg(F.count("*").alias("df"), F.max("w").alias("top")).filter(F.col("df") > 1)
    terms = _stored(terms.withColumn("tid", F.monotonically_increasing_id()))
    placed = _stored(kept.join(terms, "term").select("id", "tid", "w", "df", "top"))
    candidates = _stored(_candidates(placed, threshold - 10.0**-DIGITS, hot))
    cosine = F.round("dot", DIGITS)
    scored = _dots(placed, candidates).select("a", "b", cosine.alias("cosine"))
    return members, _stored(scored.filter(F.col("cosine") >= threshold))


def similar_pairs(vectors: DataFrame, threshold: float = 0.8, hot: int = HOT) -> DataFrame:
    """``a``, ``b`` (ids, ``a < b``), ``cosine`` (rounded to ``DIGITS``) of every pair of
    ``vectors`` whose rounded cosine is at least ``threshold``: the classes of
    :func:`similar_classes`, every member of one with every member of the other. Members of a large
    class are dealt over buckets, and those they are paired with copied to each."""
    return expanded(*similar_classes(vectors, threshold, hot), threshold)


def expanded(members: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs of ids of classes (:func:`similar_classes`). What is joined is dealt over tasks by the pairs that come of it."""
    within = members.groupBy("rep").agg(F.count("*").alias("m"))
    linked = pairs.unionByName(
        within.filter((F.col("m") > 1) & F.lit(threshold <= 1)).select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("cosine"))
    )
    parts = F.ceil(F.col("m") / _MEMBERS).cast("int")
    dealt = members.join(within, "rep")
    left = dealt.select(F.col("rep").alias("a"), F.col("id").alias("x"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("bucket"))
    right = members.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    buckets = within.select(F.col("rep").alias("a"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("bucket"))
    many = (within.agg(F.sum(F.col("m").cast("double") * F.col("m")) / 2).first()[0] or 0) + pairs.count()
    # every member of b once for each bucket of a
    asked = linked.join(buckets, "a").join(right, "b").repartition(min(2_000, ceil(many / _PAIRS) + 1), "a", "bucket")
    joined = asked.join(left, ["a", "bucket"]).filter((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cosine")
