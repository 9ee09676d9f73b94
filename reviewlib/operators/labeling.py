"""Weak sentiment labels from ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.ratings import message_ratings, parse_rating, rating_label, rating_median
from reviewlib.functions.text import clean_message
from reviewlib.operators.once import compute_once


def rating_number(rating: Column | str, message: Column | str) -> Column:
    """The rating cell's number, else the median of the ratings in the message, else null."""
    return F.coalesce(parse_rating(rating), rating_median(message_ratings(message)))


def rate_reviews(
    df: DataFrame, strip_emojis: bool = True, ratings_from: str = "clean"
) -> DataFrame:
    """Cleaned message, ``rating_num`` and ``label`` of every row, null where there is none."""
    if ratings_from not in ("clean", "raw"):
        raise ValueError("ratings_from must be 'clean' or 'raw'")
    cleaned = {"message": clean_message("message", strip_emojis)}
    number = rating_number("rating", "message")
    if ratings_from == "raw":
        rated = compute_once(df, {**cleaned, "rating_num": number})
    else:
        rated = compute_once(compute_once(df, cleaned), {"rating_num": number})
    return rated.withColumn("label", rating_label("rating_num"))


def usable() -> Column:
    """Whether a rated row has a message and a label."""
    return (F.length("message") > 0) & F.col("label").isNotNull()


def label_reviews(
    df: DataFrame, strip_emojis: bool = True, ratings_from: str = "clean"
) -> DataFrame:
    """Cleaned message, ``rating_num`` and ``label``, for the rows that have a message
    and a label.

    Cleaning cuts a trailing block of sub-ratings, so with ``ratings_from="clean"`` such
    a block gives no rating; ``"raw"`` searches the message as it came.
    """
    return rate_reviews(df, strip_emojis, ratings_from).filter(usable())


def labeling_summary(
    df: DataFrame, strip_emojis: bool = True, ratings_from: str = "clean"
) -> DataFrame:
    """One row: ``rows_in`` and ``rows_usable``."""
    return rate_reviews(df, strip_emojis, ratings_from).agg(
        F.count("*").alias("rows_in"), F.count_if(usable()).alias("rows_usable")
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)
