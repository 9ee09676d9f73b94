"""Preparing review tables: cleaned columns with lengths, and exploration features."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.patterns import REVIEW_COLUMNS
from reviewlib.functions.ratings import coerce_rating, normalize_photos
from reviewlib.functions.text import basic_clean, has_url, strip, text_length, word_count
from reviewlib.sources.tables import require_columns


def _cleaned(field: str, default_if_empty: str) -> Column:
    s = strip(F.coalesce(F.col(field).cast("string"), F.lit("")))
    if field == "number_of_photos":
        s = F.when(s == "", F.lit(default_if_empty)).otherwise(s)
    return basic_clean(s)


def prepare_columns(df: DataFrame, field: str, default_if_empty: str = "") -> DataFrame:
    """Add ``<field>_clean`` and ``<field>_length``; an empty photo count takes the default."""
    require_columns(df, [field], KeyError)
    return df.select("*", _cleaned(field, default_if_empty).alias(f"{field}_clean")).select(
        "*", F.length(f"{field}_clean").alias(f"{field}_length")
    )


def preprocess_reviews(df: DataFrame) -> DataFrame:
    """:func:`prepare_columns` for the four review columns, photos defaulting to ``"0"``."""
    require_columns(df, REVIEW_COLUMNS, KeyError)
    for field in REVIEW_COLUMNS:
        df = prepare_columns(df, field, "0")
    return df


def eda_features(df: DataFrame) -> DataFrame:
    """Exploration columns: trimmed name and message, ``rating_raw`` and numeric ``rating``,
    ``number_of_photos_norm``, ``len_chars``, ``len_words``, ``has_url``.

    A missing input column is warned about and replaced by its default.
    """
    for c in REVIEW_COLUMNS:
        if c not in df.columns:
            warnings.warn(f"column missing: {c}", stacklevel=2)

    def text(c: str) -> Column:
        return strip(F.coalesce(F.col(c), F.lit(""))) if c in df.columns else F.lit("")

    new = {"name": text("name"), "message": text("message")}
    if "rating" in df.columns:
        new["rating_raw"] = F.col("rating")
        new["rating"] = coerce_rating(F.col("rating").cast("string"))
    else:
        new["rating"] = F.lit(None).cast("double")
    if "number_of_photos" in df.columns:
        new["number_of_photos_norm"] = normalize_photos(F.col("number_of_photos").cast("string"))
    else:
        new["number_of_photos_norm"] = F.lit("0")
    return df.withColumns(new).withColumns(
        {
            "len_chars": text_length("message"),
            "len_words": word_count("message"),
            "has_url": has_url("message"),
        }
    )
