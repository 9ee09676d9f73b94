"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.llm.common import map_texts, quoted, stored
from reviewlib.llm.samples import bounded_sample
from reviewlib.llm.words import Coder

# The parameter that bounds the model: documents learned from per language.
SAMPLE = 5_000
SIZES = (5, 4, 3, 2, 1)
UNKNOWN = "und"
# What a word or n-gram that a language has not shown counts there.
_UNSEEN = 0.05
_CACHE = 100_000


@dataclass
class Model:
    """Log frequencies per language (a column each) of words, sorted by code, and of n-grams."""

    languages: list[str]
    codes: np.ndarray
    words: np.ndarray
    gram_row: dict[str, int]
    grams: np.ndarray


def folded(text: Column) -> Column:
    """Lower case, with one blank for whatever is not a letter."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def _log_frequencies(counts: pa.Table, languages: list[str], key: str) -> tuple[pa.Array, np.ndarray]:
    """Each ``key`` of ``counts`` (``lang``, ``key``, ``n``) once, ascending, and its log frequencies."""
    names = counts[key].combine_chunks().dictionary_encode()
    lang = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy()
    values = np.full((len(names.dictionary), len(languages)), _UNSEEN)
    values[names.indices.to_numpy(), lang] += counts["n"].to_numpy()
    order = pc.array_sort_indices(names.dictionary)
    values = np.log(values / values.sum(0)).astype(np.float32)
    return names.dictionary.take(order), values[order.to_numpy()]


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = SAMPLE
) -> Model:
    """Counts words per language in at most about ``sample`` documents each, and the n-grams of the
    counted words. All that were counted are kept, so no language is pushed out by the others."""
    known = docs.select(
        quoted(id).cast("long").alias("doc_id"),
        quoted(lang).cast("string").alias("lang"),
        quoted(text).cast("string").alias("t"),
    ).filter("lang IS NOT NULL AND t IS NOT NULL")
    chosen = bounded_sample(known, "lang", "doc_id", sample)
    words = chosen.select("lang", F.explode(F.split(folded(F.col("t")), " ")).alias("word"))
    counts = words.filter("word != ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    counts = stored(counts)
    grams = counts.select("lang", "n", F.explode(F.lit(list(SIZES))).alias("k"), F.concat(F.lit("<"), "word", F.lit(">")).alias("w"))
    grams = grams.filter(F.length("w") >= F.col("k")).select(
        "lang",
        "n",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("w") - F.col("k") + 1),
                lambda i: F.substring(F.col("w"), i, F.col("k")),
            )
        ).alias("gram"),
    )
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    # as many rows as the samples have words and n-grams, however many documents there are
    word_counts, gram_counts = counts.toArrow(), grams.toArrow()
    languages = sorted(pc.unique(word_counts["lang"]).to_pylist())
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), {}, np.zeros((0, 0)))
    names, values = _log_frequencies(word_counts, languages, "word")
    codes = np.concatenate([g.codes for g in Coder(lower=False).groups(names)])
    order = np.argsort(codes)
    grams_kept, gram_values = _log_frequencies(gram_counts, languages, "gram")
    rows = {g: i for i, g in enumerate(grams_kept.to_pylist())}
    return Model(languages, codes[order], values[order], rows, gram_values)


class Scorer:
    """Log likelihoods of texts; one per task."""

    def __init__(self, model: Model):
        self.model = model
        self.coder = Coder(lower=False)
        self.seen: dict[int, np.ndarray] = {}

    def back_off(self, word: str) -> np.ndarray:
        """Mean over the known n-grams of the greatest size of which any is known."""
        framed = f"<{word}>"
        for k in SIZES:
            rows = [
                r
                for i in range(len(framed) - k + 1)
                if (r := self.model.gram_row.get(framed[i : i + k])) is not None
            ]
            if rows:
                return self.model.grams[rows].mean(0)
        return np.zeros(len(self.model.languages), np.float32)

    def word_scores(self, group) -> np.ndarray:
        codes = self.model.codes
        at = np.minimum(np.searchsorted(codes, group.codes), max(0, len(codes) - 1))
        known = codes[at] == group.codes
        out = self.model.words[at]
        new = np.flatnonzero(~known)
        if len(new):
            values, first, back = np.unique(group.codes[new], return_index=True, return_inverse=True)
            rows = []
            for code, i in zip(values.tolist(), new[first].tolist()):
                found = self.seen.get(code)
                if found is None:
                    word = bytes(group.data[group.starts[i] : group.ends[i]]).decode()
                    found = self.back_off(word)
                    if len(self.seen) >= _CACHE:
                        self.seen.clear()
                    self.seen[code] = found
                rows.append(found)
            out[new] = np.array(rows)[back]
        return out

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        langs: list[str] = []
        scores: list[float] = []
        for group in self.coder.groups(texts):
            if not self.model.languages or not len(group.codes):
                langs += [UNKNOWN] * (group.hi - group.lo)
                scores += [0.0] * (group.hi - group.lo)
                continue
            totals = np.zeros((len(group.codes) + 1, len(self.model.languages)))
            np.cumsum(self.word_scores(group), axis=0, dtype=np.float64, out=totals[1:])
            sums = totals[group.bounds[1:]] - totals[group.bounds[:-1]]
            best = sums.argmax(1)
            share = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
            empty = group.bounds[1:] == group.bounds[:-1]
            langs += [UNKNOWN if e else self.model.languages[b] for e, b in zip(empty, best)]
            scores += np.where(empty, 0.0, share).tolist()
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]


_SCHEMA = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the likelihood's share among the languages.

    A word that the model knows counts its log frequency in each language; another backs off to
    its n-grams. Equal languages give the first by name. A null text or one without letters is
    ``und`` with score 0, as is every text when nothing could be learned.
    """
    own = "_folded"
    while own in docs.columns:
        own += "_"
    rows = docs.withColumn(own, folded(quoted(text).cast("string")))
    return map_texts(rows, own, _SCHEMA, lambda: Scorer(model)).drop(own)
