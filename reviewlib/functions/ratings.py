"""Ratings: reading them from cells and messages, and the labels they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlib.functions import patterns as P
from reviewlib.functions.text import _column, _filled, _let, strip


def _number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def _numbers(c: Column | str, pattern: str) -> Column:
    found = F.regexp_extract_all(_filled(c), F.lit(P.unicode(pattern)), F.lit(1))
    return F.transform(found, _number)


def extract_rating_text(c: Column | str) -> Column:
    """Mean of every ``x/5`` in a dump comment, as ``"4.2/5"``; ``""`` when there is none.

    ``format_number`` rounds the binary value, as ``%.1f`` does.
    """
    mean = F.aggregate(
        _numbers(c, P.DUMP_RATING),
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), (acc["n"] + 1).alias("n")),
        lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]),
    )
    text = F.concat(F.call_function("format_number", mean, F.lit("0.0")), F.lit("/5"))
    return F.coalesce(text, F.lit(""))


def parse_rating(c: Column | str) -> Column:
    """First number of a rating cell on the 0-5 scale; above 5 it is read as 0-100."""
    v = _number(F.regexp_extract(_filled(c), P.FIRST_NUMBER, 1))
    return F.when(v <= 5, v).when(v <= 100, v / 20).when(v.isNotNull(), F.lit(5.0))


def message_ratings(c: Column | str) -> Column:
    """Every ``x/5`` with 0 <= x <= 5 in a message, in order; ``[]`` for null."""
    return F.filter(_numbers(c, P.MESSAGE_RATING), lambda v: v.between(0, 5))


def rating_median(ratings: Column | str) -> Column:
    """Median of an array of ratings, null when it is empty."""

    def median(ordered: Column) -> Column:
        n = F.size(ordered)
        low, high = ((n - 1) / 2).cast("int"), (n / 2).cast("int")
        return F.when(n > 0, (F.get(ordered, low) + F.get(ordered, high)) / 2)

    return _let(F.array_sort(_column(ratings)), median)


def rating_label(c: Column | str) -> Column:
    """4 and up positive, 2 and down negative, between them neutral, null for null."""
    v = _column(c)
    return (
        F.when(v >= 4, F.lit("positive"))
        .when(v <= 2, F.lit("negative"))
        .when(v.isNotNull(), F.lit("neutral"))
    )


def coerce_rating(c: Column | str) -> Column:
    """A whole cell as a number, null when any of it is not one.

    The check comes first because Spark's cast also takes ``4.7d``.
    """
    c = _column(c)
    return F.when(c.rlike(P.unicode(P.NUMERIC, "i")), strip(c).try_cast("double"))


def normalize_photos(c: Column | str) -> Column:
    """Photo count as a whole-number string, ``"0"`` for anything else."""
    s = F.regexp_replace(strip(_filled(c)), r"\.0+\z", "")
    return F.when(s.rlike(r"^[0-9]+\z"), s).otherwise(F.lit("0"))
