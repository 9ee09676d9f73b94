"""Dumps to review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlib.functions.patterns import DumpFormat, unicode
from reviewlib.functions.ratings import extract_rating_text
from reviewlib.functions.text import (
    _let,
    clean_dump_message,
    normalize_dump,
    sanitize_field,
    strip,
)
from reviewlib.operators.ranking import id_block, running_total


# Put before and after what the header pattern matches. A normalised dump has a blank on
# each side of every "|", so neither occurs in it, nor arises where text ends in "|".
_START, _END = "|\n|", "|\n\n|"


def _cut(text: Column, fmt: DumpFormat) -> Column:
    """Cut a normalised dump in front of each match of the header pattern, in one pass. A
    part is a match, a mark, and the text up to the next match; the first has no match."""
    marked = F.regexp_replace(text, F.lit(fmt.header_regex), F.lit(f"{_START}$0{_END}"))
    return F.split(marked, r"\|\n\|", -1)


def _last_line(part: Column) -> Column:
    """The end of a part since its last line end or separator: the name of the next header."""
    return F.substring_index(F.substring_index(part, "|", -1), "\n", -1)


def _headers(parts: Column, fmt: DumpFormat) -> Column:
    def header(part: Column, i: Column) -> Column:
        return F.struct(
            strip(_last_line(F.get(parts, i - 1))).alias("name"),
            _header_group(part, 1, fmt).alias("reviews"),
            _header_group(part, 2, fmt).alias("photos"),
        )

    every = F.transform(parts, header)
    return F.slice(every, F.lit(2), F.size(parts))


def _header_group(part: Column | str, k: int, fmt: DumpFormat) -> Column:
    """A group of the match a part starts with."""
    match = F.substring_index(part, _END, 1)
    return F.regexp_extract(match, unicode(f"^(?:{fmt.header})", "i"), k)


def find_headers(text: Column | str, fmt: DumpFormat = DumpFormat()) -> Column:
    """Array of ``(name, reviews, photos)`` for the headers of a normalised dump, with
    ``""`` for an absent photo count."""
    text = F.col(text) if isinstance(text, str) else text
    return _let(_cut(text, fmt), lambda parts: _headers(parts, fmt))


def _pieces(df: DataFrame, fmt: DumpFormat) -> DataFrame:
    """A row per part of ``_parts``: its number ``_k``, the ``_name`` and ``_photos`` of the
    header it starts with (unless ``_k`` is 0), and the ``_body`` after that, up to the name of
    the next header."""
    keep = [c for c in df.columns if c != "_parts"]

    def piece(part: Column, i: Column) -> Column:
        return F.struct(
            part.alias("part"),
            _last_line(F.get("_parts", i - 1)).alias("name"),
            (i < F.size("_parts") - 1).alias("more"),
        )

    parts = df.select(*keep, F.posexplode(F.transform("_parts", piece)).alias("_k", "_z"))
    text = F.when(F.col("_k") > 0, F.split_part("_z.part", F.lit(_END), F.lit(2)))
    named = parts.select(
        *keep,
        "_k",
        F.col("_z.name").alias("_name"),
        F.when(F.col("_k") > 0, _header_group("_z.part", 2, fmt)).alias("_photos"),
        text.otherwise(F.col("_z.part")).alias("_text"),
        F.col("_z.more").alias("_more"),
    )
    before_name = F.length("_text") - F.length(_last_line(F.col("_text")))
    body = F.when(F.col("_more"), F.left("_text", before_name)).otherwise(F.col("_text"))
    return named.select(*keep, "_k", "_name", "_photos", body.alias("_body"))


def _review(df: DataFrame, keep: list[str], fmt: DumpFormat) -> DataFrame:
    """Fields of a review. The rating is read before noise goes, so a rating quoted in an
    owner's reply counts."""
    body = df.select(
        *keep, "_name", "_photos", strip(F.ltrim(F.col("_body"), F.lit(" |"))).alias("_body")
    )
    return body.select(
        *keep,
        sanitize_field(strip("_name")).alias("name"),
        sanitize_field(extract_rating_text("_body")).alias("rating"),
        sanitize_field("_photos").alias("number_of_photos"),
        sanitize_field(clean_dump_message("_body", fmt)).alias("message"),
    )


def parse_dumps(df: DataFrame, dump: str = "dump", fmt: DumpFormat = DumpFormat()) -> DataFrame:
    """Reviews of whole dumps, one dump per row: the other columns of ``df``,
    ``review_no`` (from 1), ``name``, ``rating``, ``number_of_photos``, ``message``.

    No shuffle. Text before the first header is dropped, and a comment without a header
    belongs to the review before it.
    """
    keys = [c for c in df.columns if c != dump]
    cut = df.select(*keys, _cut(normalize_dump(dump), fmt).alias("_parts"))
    pieces = _pieces(cut, fmt).filter(F.col("_k") > 0)
    numbered = pieces.withColumn("review_no", F.col("_k").cast("long"))
    return _review(numbered, [*keys, "review_no"], fmt)


def cut_comments(
    df: DataFrame,
    source: str = "source",
    ord: str = "ord",
    comment: str = "comment",
    block: str | None = None,
    fmt: DumpFormat = DumpFormat(),
) -> DataFrame:
    """First half of :func:`parse_comments`: comments cut at their headers. All the
    pattern matching that depends on no other comment."""
    return (
        df.filter(F.col(comment).isNotNull())
        .select(
            F.col(source),
            (F.col(block) if block else id_block(ord)).alias("_block"),
            F.col(ord).alias("_ord"),
            _cut(strip(normalize_dump(comment)), fmt).alias("_parts"),
        )
        .withColumn("_headers", F.size("_parts") - 1)
    )


def join_comments(
    cut: DataFrame, source: str = "source", fmt: DumpFormat = DumpFormat()
) -> DataFrame:
    """Second half of :func:`parse_comments`: reviews numbered and put together."""
    numbered = running_total(cut, [source], "_block", ["_ord"], "_headers", "_last")
    before = F.col("_last") - F.col("_headers")
    pieces = _pieces(numbered, fmt).withColumn("review_no", before + F.col("_k"))
    joined = F.when(F.col("_k") == 0, F.concat(F.lit(" | "), "_body")).otherwise(F.col("_body"))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_ord", "_k", joined.alias("text"))))
    reviews = (
        pieces.filter(F.col("review_no") > 0)
        .groupBy(source, "review_no")
        .agg(
            F.max("_name").alias("_name"),
            F.max("_photos").alias("_photos"),
            F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("_body"),
        )
    )
    return _review(reviews, [source, "review_no"], fmt)


def parse_comments(
    df: DataFrame,
    source: str = "source",
    ord: str = "ord",
    comment: str = "comment",
    block: str | None = None,
    fmt: DumpFormat = DumpFormat(),
) -> DataFrame:
    """What :func:`parse_dumps` gives for the dump ``comment``s of a source make when
    joined in ``ord`` order, without ever joining them.

    Headers cannot reach across a separator, so each comment is cut by itself. A running
    count of headers numbers the reviews of a source; it restarts from carried totals in
    each ``block`` (by default a range of ``ord``, which must then be an integer unique
    in its source), so a large source is spread over many tasks. What precedes
    a comment's first header goes to the last review before it. Blanks that open a dump
    are trimmed.

    The totals and the reviews each need the cut comments. A job may keep those in a table
    between :func:`cut_comments` and :func:`join_comments`, to cut only once.
    """
    return join_comments(cut_comments(df, source, ord, comment, block, fmt), source, fmt)
