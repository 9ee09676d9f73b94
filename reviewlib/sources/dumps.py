"""Raw dumps: comments of one source in one text, joined by a separator."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlib.functions.patterns import WS, DumpFormat, unicode
from reviewlib.functions.text import flatten_comment
from reviewlib.operators.ranking import first_per_group
from reviewlib.sources.pages import elements

# Fixed value: the class of a comment element.
COMMENT_CLASS = "bwb7ce"

# In these encodings a byte of "|" is always a "|", so files can be cut before they are decoded.
_CUTTABLE = re.compile(r"UTF-?8|US-ASCII|ISO-8859-[0-9]+|WINDOWS-125[0-9]", re.IGNORECASE)


def read_dumps(spark: SparkSession, path: str, fmt: DumpFormat = DumpFormat()) -> DataFrame:
    """One row per file: ``source_file``, ``dump``. A file must fit in a task; see
    :func:`read_dump_pieces` for larger ones."""
    if fmt.encoding.upper() in ("UTF-8", "UTF8"):
        text, files = F.col("value"), spark.read.text(path, wholetext=True)
    else:
        text = F.decode("content", fmt.encoding)
        files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("source_file"), text.alias("dump"))


def read_dump_pieces(
    spark: SparkSession, path: str, fmt: DumpFormat = DumpFormat(), source: str = "file"
) -> DataFrame:
    """Dumps of any size, cut at the separator so that Spark can split the files.

    A dump is a file, or with ``source="folder"`` all files of a folder in order of their names.
    ``block`` is the file split a piece was read from and ``ord`` its place in the split, as
    :func:`reviewlib.operators.parse.parse_comments` wants them. An encoding in which a byte of
    the separator can be part of another character is an error.
    """
    if not _CUTTABLE.fullmatch(fmt.encoding):
        raise ValueError(f"dumps in {fmt.encoding} cannot be read in pieces")
    if source not in ("file", "folder"):
        raise ValueError(f"unknown source {source!r}")
    text = F.col("value")
    if fmt.encoding.upper() not in ("UTF-8", "UTF8"):
        text = F.decode(text.cast("binary"), fmt.encoding)
    file = F.col("_metadata.file_path")
    pieces = spark.read.text(path, lineSep="|")
    return pieces.select(
        (F.regexp_replace(file, "/[^/]*$", "") if source == "folder" else file).alias("source_file"),
        F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("start")).alias(
            "block"
        ),
        F.monotonically_increasing_id().alias("ord"),
        text.alias("comment"),
    )


def dump_comments(
    df: DataFrame,
    source: str = "source",
    ord: str = "ord",
    comment: str = "comment",
    max_comments: int | None = None,
) -> DataFrame:
    """Comments as they go into a dump: on one line, trimmed, blanks dropped, and if asked
    only the first ``max_comments`` of each source."""
    flat = df.withColumn(comment, flatten_comment(comment)).filter(F.col(comment) != "")
    return flat if max_comments is None else first_per_group(flat, source, ord, max_comments)


def write_dumps(
    df: DataFrame,
    path: str,
    source: str = "source",
    ord: str = "ord",
    comment: str = "comment",
    max_comments: int | None = None,
    mode: str = "error",
) -> None:
    """Text files under ``<source>=<value>/``: comments in ``ord`` order, a ``|`` after each. A large
    source has several files, in order of their names; no task gathers one."""
    kept = dump_comments(df, source, ord, comment, max_comments)
    spaced = kept.select(source, ord, F.concat(F.lit(" "), comment, F.lit(" ")).alias("value"))
    ordered = spaced.repartitionByRange(source, ord).sortWithinPartitions(source, ord)
    ordered.drop(ord).write.mode(mode).partitionBy(source).option("lineSep", "|").text(path)


def page_elements(
    html: Column | str,
    css_class: str = COMMENT_CLASS,
    tag: str = "div",
    max_comments: int | None = None,
) -> Column:
    """Whole texts of a page's ``<tag class="css_class">`` elements, nested ones too, on one line,
    trimmed, blanks dropped, all or the first ``max_comments``: see :func:`pages.elements`."""
    return elements(html, tag, "class", css_class, max_comments)
