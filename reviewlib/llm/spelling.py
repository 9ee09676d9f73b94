"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted over the whole corpus (Spark, partial aggregation first, so a very common word
is one row per task before the exchange). Two words are near if one inserted, deleted or replaced
code point turns one into the other. Candidates meet in blocks: a class ``c`` pairs words of
length ``c`` ("short") with words of length ``c`` or ``c + 1``; an edit leaves either the first or
the last ``c // 2`` code points of both words unchanged, so every near pair shares a block keyed by
(prefix or suffix, ``c``, those code points). A pair is counted in its prefix block, and in its
suffix block only when the prefixes differ, so it is counted once.

Inside a block the index is bit-sliced: for every (position, letter), a bitset over the block's
words of a length. A query word runs word-parallel recurrences over its positions that carry two
sets at once, words matching so far with no error and with one (replacement; or one skipped
letter, shifted by a position, for insertion and deletion), so a whole block is answered with
a few bitwise operations per letter. A block of more than ``CHUNK`` words is cut into chunks; each
(query chunk, index chunk) pair is one group, so no task holds more than ``2 * CHUNK`` words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.llm.common import stored

CHUNK = 4096
# Queries answered per numpy step.
_QUERIES = 512

_OUT = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n_near", T.LongType()),
        T.StructField("best_n", T.LongType()),
        T.StructField("best", T.StringType()),
    ]
)


def _codes(words: list[str], letters: dict[str, int]) -> np.ndarray:
    width = max((len(w) for w in words), default=0)
    out = np.zeros((len(words), width), np.int32)
    for i, w in enumerate(words):
        out[i, : len(w)] = [letters[ch] for ch in w]
    return out


def _index(codes: np.ndarray, length: int, alphabet: int) -> np.ndarray:
    """Bitsets (position, letter, word blocks of 64) of words of one length."""
    count = len(codes)
    blocks = max(1, -(-count // 64))
    out = np.zeros((length, alphabet, blocks), np.uint64)
    padded = np.full(blocks * 64, -1, np.int32)
    for i in range(length):
        padded[:count] = codes[:, i]
        for a in np.unique(codes[:, i]):
            out[i, a] = np.packbits(padded == a, bitorder="little").view(np.uint64)
    return out


def _ones(count: int) -> np.ndarray:
    blocks = max(1, -(-count // 64))
    bits = np.zeros(blocks * 64, bool)
    bits[:count] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _same_length(q: np.ndarray, index: np.ndarray, count: int) -> np.ndarray:
    """Words of the index with exactly one replaced letter, for each query row of ``q``."""
    exact = np.broadcast_to(_ones(count), (len(q), index.shape[2])).copy()
    one = np.zeros_like(exact)
    for i in range(q.shape[1]):
        match = index[i, q[:, i]]
        one = (one & match) | (exact & ~match)
        exact &= match
    return one


def _longer(q: np.ndarray, index: np.ndarray, count: int) -> np.ndarray:
    """Words of the index (one letter longer) that are a query with one letter inserted."""
    exact = np.broadcast_to(_ones(count), (len(q), index.shape[2])).copy()
    skipped = np.zeros_like(exact)
    for i in range(q.shape[1]):
        skipped = (skipped | exact) & index[i + 1, q[:, i]]
        exact &= index[i, q[:, i]]
    return skipped | exact


def _shorter(q: np.ndarray, index: np.ndarray, count: int) -> np.ndarray:
    """Words of the index (one letter shorter) that are a query with one letter deleted.

    ``exact``: words equal to the query's first letters so far; ``skipped``: equal to them with
    one letter of the query left out."""
    exact = np.broadcast_to(_ones(count), (len(q), index.shape[2])).copy()
    skipped = exact.copy()
    for i in range(1, q.shape[1]):
        before = exact & index[i - 1, q[:, i - 1]]
        skipped = (skipped & index[i - 1, q[:, i]]) | before
        exact = before
    return skipped


def near_in_block(table: pa.Table) -> pa.Table:
    """Per query word of one (block, query chunk, index chunk): near words, and the best of them
    (most occurrences, then least in code-point order)."""
    kind, c = table.column("kind")[0].as_py(), table.column("c")[0].as_py()
    words = table.column("word").to_pylist()
    ns = table.column("n").to_numpy()
    side = table.column("side").to_pylist()
    queries = [i for i, s in enumerate(side) if s != "i"]
    indexed = [i for i, s in enumerate(side) if s != "q"]
    letters = {ch: k for k, ch in enumerate(sorted({ch for w in words for ch in w}))}
    alphabet = max(1, len(letters))
    short = [i for i in indexed if len(words[i]) == c]
    long_ = [i for i in indexed if len(words[i]) == c + 1]
    k = c // 2
    found_q, found_p = [], []
    for group, length in ((short, c), (long_, c + 1)):
        if not group:
            continue
        codes = _codes([words[i] for i in group], letters)
        index = _index(codes, length, alphabet)
        for qlen in (c, c + 1):
            asking = [i for i in queries if len(words[i]) == qlen]
            if not asking or (qlen == c + 1 and length == c + 1):
                continue  # long-long pairs belong to the next class
            qcodes = _codes([words[i] for i in asking], letters)
            for lo in range(0, len(asking), _QUERIES):
                q = qcodes[lo : lo + _QUERIES]
                if qlen == length:
                    bits = _same_length(q, index, len(group))
                elif length == qlen + 1:
                    bits = _longer(q, index, len(group))
                else:
                    bits = _shorter(q, index, len(group))
                hit = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, : len(group)]
                rows, cols = np.nonzero(hit)
                found_q.extend(asking[lo + r] for r in rows)
                found_p.extend(group[j] for j in cols)
    pairs = [
        (a, b) for a, b in zip(found_q, found_p)
        if words[a] != words[b] and (kind == "p" or words[a][:k] != words[b][:k])
    ]
    best: dict[int, tuple[int, int, str]] = {}
    for a, b in pairs:
        count, top_n, top = best.get(a, (0, -1, ""))
        better = ns[b] > top_n or (ns[b] == top_n and words[b] < top)
        best[a] = (count + 1, int(ns[b]), words[b]) if better else (count + 1, top_n, top)
    return pa.table(
        {
            "word": pa.array([words[a] for a in best], pa.string()),
            "n_near": pa.array([v[0] for v in best.values()], pa.int64()),
            "best_n": pa.array([v[1] for v in best.values()], pa.int64()),
            "best": pa.array([v[2] for v in best.values()], pa.string()),
        },
        schema=pa.schema([(f.name, pa.string() if f.name in ("word", "best") else pa.int64()) for f in _OUT]),
    )


def near_words(vocabulary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``word``, ``n``, ``n_near`` (near words), ``best_n``, ``best`` (the near word of most
    occurrences, ties the least; nulls without near words) for every row of ``vocabulary``
    (``word`` distinct non-null strings of at least 2 code points, ``n`` long)."""
    length = F.char_length("word")
    keyed = vocabulary.select(
        "word",
        "n",
        F.explode(F.array(length, length - 1)).alias("c"),
    ).filter(F.col("c") >= 2)
    half = F.floor(F.col("c") / 2).cast("int")
    keyed = keyed.select(
        "word", "n", "c",
        F.explode(F.array(
            F.struct(F.lit("p").alias("kind"), F.substring("word", 1, half).alias("key")),
            F.struct(F.lit("s").alias("kind"), F.substring(F.col("word"), length - half + 1, half).alias("key")),
        )).alias("b"),
    ).select("word", "n", "c", "b.kind", "b.key")
    block = ["kind", "c", "key"]
    sizes = keyed.groupBy(*block).agg(
        F.count("*").alias("size"), F.sum((F.char_length("word") == F.col("c")).cast("int")).alias("shorts")
    )
    # a block without a word of length c has no pair to find; one of a single word neither
    live = sizes.filter((F.col("shorts") > 0) & (F.col("size") > 1)).select(
        *block, F.ceil(F.col("size") / chunk).cast("int").alias("parts")
    )
    members = keyed.join(live, block).withColumn("part", (F.abs(F.xxhash64("word")) % F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asked = members.select(*block, "word", "n", F.col("part").alias("qpart"), other.alias("ipart"), F.lit("q").alias("side"))
    held = members.select(*block, "word", "n", other.alias("qpart"), F.col("part").alias("ipart"), F.lit("i").alias("side"))
    groups = asked.unionByName(held)
    found = groups.groupBy(*block, "qpart", "ipart").applyInArrow(near_in_block, _OUT)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    per_word = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return vocabulary.join(per_word, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("top.m")).cast("long").alias("best_n"),
        F.col("top.w").alias("best"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: from each word, its ``form`` followed to the last (``word`` itself when
    it has none). Chains must end (forms here have ten times the occurrences of their word);
    pointers are doubled, one join a round, until no root moves."""
    step = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        up = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = step.join(up, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), (F.col("further") != F.col("root")).alias("m")
        )
        moved = stored(moved)
        if moved.filter(F.col("m")).limit(1).count() == 0:
            return moved.select("word", "root")
        step = moved.select("word", "root")


def run_words(text: Column) -> Column:
    """Maximal runs of ASCII and Latin-1 letters of ``text``, A-Z lowered; empty for null."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([A-Za-z\\x{C0}-\\x{FF}]+)"), 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.transform(runs, lambda r: F.translate(r, upper, upper.lower()))
