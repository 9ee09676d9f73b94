"""Vocabulary of training texts, and texts as fixed-length id sequences.

Follows the public rules of the Keras text vectoriser: ASCII letters to lower case,
ASCII punctuation deleted, split at ASCII whitespace; words ranked by count, ties by
descending bytes; id 0 pads, id 1 stands for an unknown word.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.functions.patterns import PAD_ID, PUNCTUATION, UNKNOWN_ID

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(text: Column | str) -> Column:
    """Array of words of a text, ``[]`` for null."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    bare = F.regexp_replace(F.translate(c, _UPPER, _LOWER), PUNCTUATION, "")
    return F.filter(F.split(bare, r"[\t-\r ]+"), lambda t: t != "")


def build_vocabulary(df: DataFrame, text: str = "message", num_words: int = 20_000) -> DataFrame:
    """``token``, ``token_id`` and ``n`` of the ``num_words - 2`` most frequent words."""
    words = df.select(F.explode(tokens(text)).alias("token"))
    counts = words.groupBy("token").agg(F.count("*").alias("n"))
    rank = [F.desc("n"), F.desc("token")]
    kept = counts.orderBy(*rank).limit(num_words - 2)
    # at most num_words - 2 rows reach this window
    nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*rank))
    return kept.select("token", (nth + UNKNOWN_ID).alias("token_id"), "n")


def _ids_of(known: list[str], ids: list[int]):
    # a local function is shipped to the workers itself, so they need not have this package
    table, numbers = pa.array(known, pa.string()), pa.array(ids, pa.int32())

    def look_up(words: pa.Array) -> pa.Array:
        flat = words.flatten()
        found = numbers.take(pc.index_in(flat, value_set=table)).fill_null(UNKNOWN_ID)
        sizes = pc.list_value_length(words).fill_null(0)
        ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes.cast(pa.int64()))])
        return pa.ListArray.from_arrays(ends.cast(pa.int32()), found)

    return F.arrow_udf(look_up, "array<int>")


def encode_sequences(
    df: DataFrame,
    vocabulary: DataFrame,
    id: str = "review_id",
    text: str = "message",
    seq_len: int = 200,
) -> DataFrame:
    """``id`` and ``ids``: the ids of the first ``seq_len`` words, padded to that length.

    ``vocabulary`` comes from :func:`build_vocabulary`, whose ``num_words`` bounds what goes to the
    tasks. Each row is encoded by itself: words are cut in the JVM, and looked up in batches.
    """
    known = vocabulary.select("token", "token_id").collect()
    look_up = _ids_of([r[0] for r in known], [r[1] for r in known])
    ids = df.select(id, look_up(F.slice(tokens(text), 1, seq_len)).alias("ids"))
    padding = F.array_repeat(F.lit(PAD_ID), F.lit(seq_len) - F.size("ids"))
    return ids.select(id, F.concat("ids", padding).alias("ids"))
