"""Stylometry: function-word profiles of authors and Burrows' delta between them.

A profile is the relative frequency of each function word among all words (the vocabulary's
rule) of an author's reviews. Frequencies are made z-scores against the mean and the sample
standard deviation over authors (a word that does not vary scores 0 everywhere), and the delta of
two profiles is the mean absolute difference of their z-scores (given rounded to 9 decimals). Counts are summed per author by an
aggregate with partial sums per task, so an author with a third of all reviews is a few rows
before the exchange; only tables of authors are joined with each other.

No table of authors is paired with itself. For a review, the leave-one-out delta compares the review's own profile with its author's profile
without it (counts minus the review's), using the same corpus means and deviations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.operators.once import compute_once
from reviewlib.operators.vocabulary import tokens
from reviewlib.scratch import scratch_dir

# The function words of the profiles.
FUNCTION_WORDS = (
    "the of and to a in that it is was for on with as at by from or an be this which not but are "
    "his her they we you i he she"
).split()


def review_counts(df: DataFrame, id: str, author: str, text: str) -> DataFrame:
    """``id``, ``author``, ``total`` (words) and ``c_<word>`` of every review with a known author. A
    text is cut into words once, and only its function words are looked at word by word."""
    rows = df.filter(F.col(author).isNotNull()).select(F.col(id).alias("id"), F.col(author).alias("author"), F.col(text).alias("text"))
    cut = compute_once(rows, {"words": tokens("text")})
    some = compute_once(
        cut.select("id", "author", "words"), {"found": F.filter("words", lambda t: t.isin(FUNCTION_WORDS))}
    )
    size = F.size("found")
    counts = [(size - F.size(F.array_remove("found", w))).cast("long").alias(f"c_{w}") for w in FUNCTION_WORDS]
    return some.select("id", "author", F.size("words").cast("long").alias("total"), *counts)


def _z(frequency: Column, w: str, stats: dict[str, float]) -> Column:
    mu, sd = stats[f"mu_{w}"], stats[f"sd_{w}"]
    return (frequency - F.lit(mu)) / F.lit(sd) if sd and sd > 0 else F.lit(0.0)


def profiles(reviews: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Author profiles (``author``, ``total``, ``c_<word>``, ``z_<word>``) and the corpus statistics
    (``mu_<word>``, ``sd_<word>``: one row of numbers, to the driver). Authors without words are
    left out."""
    sums = reviews.groupBy("author").agg(
        F.sum("total").alias("total"), *(F.sum(f"c_{w}").alias(f"c_{w}") for w in FUNCTION_WORDS)
    ).filter(F.col("total") > 0)
    freq = {w: F.col(f"c_{w}") / F.col("total") for w in FUNCTION_WORDS}
    row = sums.agg(
        *(F.avg(freq[w]).alias(f"mu_{w}") for w in FUNCTION_WORDS),
        *(F.stddev_samp(freq[w]).alias(f"sd_{w}") for w in FUNCTION_WORDS),
    ).first()
    stats = {k: (v if v is not None else 0.0) for k, v in row.asDict().items()}
    z = [_z(freq[w], w, stats).alias(f"z_{w}") for w in FUNCTION_WORDS]
    return sums.select("author", "total", *(f"c_{w}" for w in FUNCTION_WORDS), *z), stats


def _delta(a: str, b: str) -> Column:
    return sum((F.abs(F.col(f"{a}_{w}") - F.col(f"{b}_{w}")) for w in FUNCTION_WORDS), F.lit(0.0)) / len(FUNCTION_WORDS)


def leave_one_out(reviews: DataFrame) -> DataFrame:
    """``id``, ``author``, ``delta``: each review with words against its author's profile without
    it; null where the author has no other words. One equi-join of reviews with their author. The
    counts are written once to the scratch folder, so texts are read once."""
    path = scratch_dir(reviews.sparkSession)
    reviews.write.parquet(path)
    reviews = reviews.sparkSession.read.parquet(path)
    found, stats = profiles(reviews)
    own = found.select("author", F.col("total").alias("t_all"), *(F.col(f"c_{w}").alias(f"a_{w}") for w in FUNCTION_WORDS))
    rows = reviews.filter(F.col("total") > 0).join(own, "author")
    rest = F.col("t_all") - F.col("total")
    review_z = [_z(F.col(f"c_{w}") / F.col("total"), w, stats).alias(f"r_{w}") for w in FUNCTION_WORDS]
    other_z = [_z((F.col(f"a_{w}") - F.col(f"c_{w}")) / rest, w, stats).alias(f"o_{w}") for w in FUNCTION_WORDS]
    scored = rows.select("id", "author", rest.alias("rest"), *review_z, *other_z)
    return scored.select("id", "author", F.when(F.col("rest") > 0, F.round(_delta("r", "o"), 9)).alias("delta"))
