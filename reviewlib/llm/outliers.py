"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.llm.common import quoted, stored

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
# The share of a group that its location and scatter are estimated from.
SUPPORT = 0.75
STEPS = 4
# Groups with fewer rows are pooled by language, and pools with fewer still over all languages.
MIN_GROUP = 50
# Quantiles of the chi-squared distribution with four degrees of freedom: 0.5 and 0.9999.
MEDIAN, CUT = 3.3567, 23.5127
# Added to each variance, as the square: deviations of this size are no evidence. Characters per
# word; shares of symbols, repeated lines and repeated words.
FLOORS = (0.25, 0.004, 0.06, 0.04)

_GROUP = ("g_lang", "g_source")
_X = tuple(f"x{i}" for i in range(len(FLOORS)))
# Values are ranked in bins, counted exactly: so many for each time that a value grows by e. A group has
# a few thousand bins at most, however many rows.
_BINS = 512


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that the text has twice or more."""
    last = F.size(words) - WINDOW + 1

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(sorted_pairs: Column) -> Column:
            def repeated(s: Column, k: Column) -> Column:
                before = F.get(sorted_pairs, k - 1)["h"] == s["h"]
                after = F.get(sorted_pairs, k + 1)["h"] == s["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.array_sort(F.transform(F.filter(sorted_pairs, repeated), lambda s: s["i"]))

        def union(at: Column) -> Column:
            step = F.transform(
                at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
            )
            return F.aggregate(step, F.lit(0), lambda n, x: n + x)

        return _let(_let(pairs, places), union)

    def count(windows: Column) -> Column:
        all_differ = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(all_differ, F.lit(0)).otherwise(covered(windows))

    hashes = F.transform(
        F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW)))
    )
    return F.when(last < 2, F.lit(0)).otherwise(_let(hashes, count)).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``g_lang``, ``g_source``, ``n_lines`` with a word, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` of every row."""

    def group(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), quoted(c).cast("string")), F.lit("")).alias(f"g_{c}")

    rows = docs.select(
        quoted(id).cast("long").alias("doc_id"),
        group("lang"),
        group("source"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("t"),
    )
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    plain = F.col("t")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    parts = rows.select(
        "doc_id",
        *_GROUP,
        words.alias("words"),
        lines.alias("lines"),
        (F.octet_length("t") - F.octet_length(plain)).cast("long").alias("n_symbols"),
    )
    return parts.select(
        "doc_id",
        *_GROUP,
        F.size("lines").cast("long").alias("n_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    """The transformed statistics. A few words are added to each text, so that the
    shares of short ones are no wilder than those of long ones."""
    return [
        (F.col("word_chars") + 250) / (F.col("n_words") + 50),
        F.col("n_symbols") / (F.col("word_chars") + 100),
        F.col("n_dup_lines") / (F.col("n_lines") + 4),
        F.col("n_repeat_words") / (F.col("n_words") + 50),
    ]


def _quantile(rows: DataFrame, value: str, share: float, out: str, unit: float = 1.0) -> DataFrame:
    """Per group, the upper end of the first bin at which ``share`` of its rows is reached. Rows are
    counted per bin first, so neither the group nor its order goes through one task. The result, a row
    per group, is written, so that joins with it know its size and can split a hot group."""
    bins = rows.groupBy(*_GROUP, F.floor(F.log1p(F.col(value) / unit) * _BINS).alias("bin")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy(*_GROUP).orderBy("bin")
    every = Window.partitionBy(*_GROUP)
    ranked = bins.withColumn("upto", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(every))
    reached = ranked.filter(F.col("upto") >= F.col("all") * share)
    return stored(reached.groupBy(*_GROUP).agg((F.expm1((F.min("bin") + 1) / _BINS) * unit).alias(out)))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``_X`` from the group's ``m`` under its triangular ``l``, by
    forward substitution."""
    solved: list[Column] = []
    for i, x in enumerate(_X):
        rest = F.col(x) - F.col(f"m{i}")
        for j, y in enumerate(solved):
            rest = rest - F.col(f"l{i}{j}") * y
        solved.append(rest / F.col(f"l{i}{i}"))
    total = solved[0] * solved[0]
    for y in solved[1:]:
        total = total + y * y
    return total


def _estimate(rows: DataFrame) -> DataFrame:
    """Per group: means ``m`` and the triangular root ``l`` of the covariance plus the floors."""
    p = range(len(_X))
    sums = rows.groupBy(*_GROUP).agg(
        *(F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)),
        *(F.covar_pop(_X[i], _X[j]).alias(f"c{i}{j}") for i in p for j in range(i + 1)),
    )
    root: dict[tuple[int, int], Column] = {}
    for i in p:
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            if i == j:
                rest = rest + FLOORS[i] ** 2
            for k in range(j):
                rest = rest - root[i, k] * root[j, k]
            if i == j:
                # the floor bounds what is left of a variance from below, rounding aside
                root[i, j] = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4)))
            else:
                root[i, j] = rest / root[j, j]
    return sums.select(
        *_GROUP,
        *(f"m{i}" for i in p),
        *(c.alias(f"l{i}{j}") for (i, j), c in root.items()),
    )


def minimum_covariance(rows: DataFrame) -> DataFrame:
    """Per group: location and scatter of the ``SUPPORT`` share of its rows with the smallest
    covariance determinant, and ``scale``, which makes distances of the bulk chi-squared.

    Starts from the half of the rows nearest to the medians and concentrates: distances,
    the nearest rows, their mean and covariance, a fixed number of times. Every pass aggregates per
    group before it shuffles.
    """
    start = rows
    for i, x in enumerate(_X):
        start = start.join(_quantile(rows, x, 0.5, f"q{i}", FLOORS[i]), list(_GROUP))
    away = [F.pow((F.col(x) - F.col(f"q{i}")) / FLOORS[i], 2) for i, x in enumerate(_X)]
    near = start.withColumn("d", sum(away[1:], away[0]))
    half = _quantile(near, "d", 0.5, "reach")
    fit = stored(_estimate(near.join(half, list(_GROUP)).filter("d <= reach")))
    for _ in range(STEPS):
        far = rows.join(fit, list(_GROUP)).withColumn("d", _distance())
        reach = _quantile(far, "d", SUPPORT, "reach")
        fit = stored(_estimate(far.join(reach, list(_GROUP)).filter("d <= reach")))
    far = rows.join(fit, list(_GROUP)).withColumn("d", _distance())
    middle = _quantile(far, "d", 0.5, "middle")
    return fit.join(middle, list(_GROUP)).withColumn(
        "scale", F.greatest(F.lit(1.0), F.col("middle") / MEDIAN)
    )


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``distance`` of every row.

    The fixed limits come first. The statistics of the rows that pass them are compared within
    their ``lang`` and ``source`` (nulls are a group of their own): a row further from its group
    than the cut is not kept. A group of fewer than ``MIN_GROUP`` rows joins the pool of its
    language, and a language pool still that small joins one pool of all such rows, so every row
    that passes the limits is judged; ``distance`` is null only where the limits failed. A null or
    empty text has no word and fails the limits.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    rows = stored(
        statistics(docs, id, text)
        .withColumn("base_failed", failed)
        .select("*", *(c.alias(x) for c, x in zip(_vector(), _X)))
    )
    passed = rows.filter(~F.col("base_failed"))
    sizes = passed.groupBy(*_GROUP).agg(F.count("*").alias("size"))
    sizes = stored(sizes.withColumn("small", F.col("size") < MIN_GROUP).drop("size"))
    pooled = F.when(F.col("small"), F.lit("*")).otherwise(F.col("g_source"))
    fitted = (
        rows.join(sizes, list(_GROUP), "left")
        .withColumn("g_source", F.when(~F.col("base_failed"), pooled).otherwise(F.lit("-")))
        .drop("small")
    )
    fitted = stored(fitted)
    passed = fitted.filter(~F.col("base_failed"))
    pools = passed.groupBy(*_GROUP).agg((F.count("*") < MIN_GROUP).alias("tiny"))
    everyone = F.when(F.coalesce("tiny", F.lit(False)), F.lit("*"))
    fitted = stored(
        fitted.join(stored(pools), list(_GROUP), "left")
        .withColumn("g_lang", F.coalesce(everyone, F.col("g_lang")))
        .withColumn("g_source", F.coalesce(everyone, F.col("g_source")))
        .drop("tiny")
    )
    passed = fitted.filter(~F.col("base_failed"))
    fit = stored(minimum_covariance(passed))
    judged = fitted.join(fit, list(_GROUP), "left").withColumn("distance", _distance() / F.col("scale"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUT, F.lit(True))).alias("kept"),
        "distance",
    )
