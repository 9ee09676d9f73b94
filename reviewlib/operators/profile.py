"""Exploration reports: missing values, summaries, distributions, suspect rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.functions.text import named
from reviewlib.operators.ranking import running_total
from reviewlib.scratch import scratch_dir

_QUARTILES = [0.25, 0.5, 0.75]


def _is_missing(df: DataFrame, c: str) -> Column:
    missing = named(c).isNull()
    if isinstance(df.schema[c].dataType, T.DoubleType | T.FloatType):
        missing = missing | F.isnan(named(c))
    return missing


def null_counts(df: DataFrame) -> DataFrame:
    """Per column: ``position``, ``column``, ``dtype``, ``nulls``. One pass."""
    counts = df.agg(*(F.count_if(_is_missing(df, c)).alias(c) for c in df.columns))
    rows = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(dtype).alias("dtype"),
                named(c).alias("nulls"),
            )
            for i, (c, dtype) in enumerate(df.dtypes)
        )
    )
    return counts.select(F.inline(rows))


def describe(df: DataFrame, max_columns: int | None = None) -> DataFrame:
    """Summary of all columns or the first ``max_columns``: ``count``; ``unique``, ``top``, ``freq``
    for those that are not numbers; ``mean``, ``std``, ``min``, ``q25``, ``q50``, ``q75``,
    ``max`` (exact) for numbers.

    Among equally frequent values ``top`` is the one with the smallest MD5, so that only
    digests are counted and shuffled; the texts of the winners are looked up afterwards.
    """
    columns = df.columns[:max_columns]
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    other = [c for c in columns if c not in numeric]
    position = {c: i for i, c in enumerate(columns)}
    parts = []
    if other:
        parts.append(_describe_values(df, {c: position[c] for c in other}))
    if numeric:
        parts.append(_describe_numbers(df, {c: position[c] for c in numeric}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("position")


def _describe_values(df: DataFrame, position: dict[str, int]) -> DataFrame:
    cells = df.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).alias("position"), named(c).cast("string").alias("value"))
                    for c, i in position.items()
                )
            )
        )
    )
    cells = cells.filter(F.col("value").isNotNull()).withColumn("digest", F.md5("value"))
    counts = cells.groupBy("position", "digest").agg(F.count("*").alias("n"))
    winners = counts.groupBy("position").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("digest", F.struct(-F.col("n"), "digest")).alias("digest"),
        F.max("n").alias("freq"),
    )
    # one row per column at most
    top = (
        cells.join(F.broadcast(winners.select("position", "digest")), ["position", "digest"])
        .groupBy("position")
        .agg(F.min("value").alias("top"))
    )
    found = winners.join(top, "position")
    every = _by_position(df, position).join(found, "position", "left")
    nothing = [
        F.lit(None).cast("double").alias(c)
        for c in ("mean", "std", "min", "q25", "q50", "q75", "max")
    ]
    return every.select(
        "position",
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        "top",
        "freq",
        *nothing,
    )


def _describe_numbers(df: DataFrame, position: dict[str, int]) -> DataFrame:
    cells = df.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).alias("position"), named(c).cast("double").alias("x"))
                    for c, i in position.items()
                )
            )
        )
    )
    found = number_summary(cells, "position", "x", _QUARTILES)
    return (
        _by_position(df, position)
        .join(found, "position", "left")
        .select(
            "position",
            "column",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.lit(None).cast("long").alias("unique"),
            F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("long").alias("freq"),
            "mean",
            "std",
            "min",
            *(F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(("q25", "q50", "q75"))),
            "max",
        )
    )


def number_summary(
    df: DataFrame, by: str, x: str, probabilities: list[float], weight: str | None = None
) -> DataFrame:
    """``count``, ``mean``, ``std``, ``min``, ``max`` and exact, linearly interpolated
    ``quantiles`` of a double column per ``by``, for few groups of any size. One pass.

    Spark's ``percentile`` holds every distinct value of a group in one task. Here values
    are counted, and ranked by running totals over value ranges. A sketch picks the
    ranges, of which there are more with more shuffle partitions; it only decides how even they
    are, not the result. With ``weight``, each row stands for that many values.
    """
    counted = F.count("*") if weight is None else F.sum(weight)
    values = (
        df.filter(~F.isnan(x) & F.col(x).isNotNull())
        .groupBy(by, F.col(x).alias("_x"))
        .agg(counted.alias("_n"))
    )
    ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    # a row per group with twice as many numbers as there are tasks: joined by broadcast, since a shuffle on the group would put
    # all values of a column in one task
    shape = values.groupBy(by).agg(
        F.sum("_n").alias("_total"),
        (F.sum(F.col("_x") * F.col("_n")) / F.sum("_n")).alias("_mean"),
        F.percentile_approx("_x", cuts).alias("_cuts"),
    )
    # always true; naming the total here keeps Spark from pruning it for the running totals,
    # and so from counting the values a second time
    place = F.when(
        F.col("_total") > 0, F.size(F.filter("_cuts", lambda cut: cut < F.col("_x")))
    )
    ranged = values.join(F.broadcast(shape), by).withColumn("_range", place).drop("_cuts")
    ranked = running_total(ranged, [by], "_range", ["_x"], "_n", "_upto")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col("_x")))

    total = F.max("_total")
    squares = F.sum(F.col("_n") * F.pow(F.col("_x") - F.col("_mean"), 2))
    places = [(F.col("_total") - 1) * p for p in probabilities]
    found = ranked.groupBy(by).agg(
        total.alias("count"),
        F.max("_mean").alias("mean"),
        F.sqrt(F.when(total > 1, squares / (total - 1))).alias("std"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
        F.array(
            *(
                F.struct(
                    at(F.floor(place)).alias("low"),
                    at(F.ceil(place)).alias("high"),
                    F.max(place - F.floor(place)).alias("part"),
                )
                for place in places
            )
        ).alias("q"),
    )
    between = F.transform(
        "q",
        lambda q: F.when(q["part"] == 0, q["low"]).otherwise(
            q["low"] + (q["high"] - q["low"]) * q["part"]
        ),
    )
    return found.withColumn("quantiles", between).drop("q")


def _by_position(df: DataFrame, position: dict[str, int]) -> DataFrame:
    rows = F.array(
        *(
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"))
            for c, i in position.items()
        )
    )
    return df.sparkSession.range(1).select(F.inline(rows))


def rating_distribution(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rows per rating in rating order, without missing ones."""
    known = df.filter(F.col(rating).isNotNull())
    return known.groupBy(rating).agg(F.count("*").alias("n")).orderBy(rating)


def histogram(df: DataFrame, column: str = "len_words", bins: int = 30) -> DataFrame:
    """Counts of an integer column in ``bins`` equal bins from its minimum to its maximum:
    ``bin``, ``low``, ``high``, ``n``, empty bins included; the last bin holds the maximum.
    When all values are equal the range is widened by a half on each side."""
    values = df.groupBy(column).agg(F.count("*").alias("n"))
    ends = df.agg(
        F.struct(F.min(column).cast("long").alias("lo"), F.max(column).cast("long").alias("hi"))
    )
    ranged = values.withColumn("_ends", ends.scalar()).select(
        F.col(column).cast("long").alias("x"),
        "n",
        F.col("_ends.lo").alias("lo"),
        F.col("_ends.hi").alias("hi"),
    )
    lo, hi = F.col("lo"), F.col("hi")
    placed = F.least(F.expr(f"(x - lo) * {bins} div (hi - lo)"), F.lit(bins - 1))
    bin_ = F.when(F.col("x").isNotNull(), F.when(hi == lo, bins // 2).otherwise(placed))
    filled = (
        ranged.groupBy("lo", "hi", bin_.cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"))
        .groupBy("lo", "hi")
        .agg(
            F.map_from_entries(
                F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))
            ).alias("counts")
        )
        .filter(lo.isNotNull())
    )
    width = F.when(hi == lo, F.lit(1.0)).otherwise((hi - lo).cast("double"))
    start = F.when(hi == lo, lo - F.lit(0.5)).otherwise(lo.cast("double"))
    bin_no = F.col("bin")
    return (
        filled.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(
            "bin",
            (start + bin_no * width / bins).alias("low"),
            (start + (bin_no + 1) * width / bins).alias("high"),
            F.coalesce(F.try_element_at("counts", bin_no), F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def box_statistics(df: DataFrame, by: str = "rating", column: str = "len_words") -> DataFrame:
    """Box-plot numbers of ``column`` per ``by``: ``n``, ``q1``, ``median``, ``q3`` and the
    whiskers, the furthest values within 1.5 interquartile ranges of the box.

    Works on counts per distinct (``by``, ``column``), so hot ratings shrink before the
    shuffle; quartiles are ranked as in :func:`number_summary`. The input is read once: the
    counts are written to the scratch folder, and quartiles, whiskers and sizes come from them.
    """
    known = df.filter(F.col(by).isNotNull())
    counted = known.groupBy(by, column).agg(F.count(column).alias("n"))
    path = scratch_dir(df.sparkSession)
    counted.write.parquet(path)
    values = df.sparkSession.read.parquet(path)
    cells = values.select(by, F.col(column).cast("double").alias("_value"), "n")
    boxes = number_summary(cells, by, "_value", _QUARTILES, weight="n").select(
        by, *(F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3")))
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(column).cast("double")
    return (
        values.join(boxes, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(x >= F.col("q1") - reach, x)).alias("low"),
            F.max(F.when(x <= F.col("q3") + reach, x)).alias("high"),
        )
        .select(
            by,
            "n",
            "q1",
            "median",
            "q3",
            F.least(F.coalesce("low", "q1"), "q1").alias("whisker_low"),
            F.greatest(F.coalesce("high", "q3"), "q3").alias("whisker_high"),
        )
        .orderBy(by)
    )


def top_authors(df: DataFrame, n: int = 20, name: str = "name") -> DataFrame:
    """The ``n`` authors with the most reviews, ties by name."""
    return df.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit(n)


def suspect_reviews(df: DataFrame, max_words: int = 3) -> DataFrame:
    """Very short messages and messages with a link."""
    return df.filter((F.col("len_words") <= max_words) | F.col("has_url"))


def duplicate_messages(df: DataFrame, message: str = "message") -> DataFrame:
    """Every row whose message occurs more than once, empty messages included.

    Messages are compared by SHA-256. Digests are counted before they are shuffled; a semi-join,
    whose hot keys Spark splits at run time, finds the rows.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(message), F.lit("")), 256))
    rows = df.withColumn("_digest", digest)
    groups = rows.groupBy("_digest").agg(F.count("*").alias("_copies"))
    several = groups.filter(F.col("_copies") > 1).select("_digest")
    return rows.join(several, "_digest", "left_semi").drop("_digest")
