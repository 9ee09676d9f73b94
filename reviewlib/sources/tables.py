"""Review tables as CSV: tolerant readers, writers, the metrics document."""

from __future__ import annotations

import csv
import re
import warnings
from collections import defaultdict
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlib.functions.patterns import NA_TOKENS, REVIEW_COLUMNS, DumpFormat
from reviewlib.functions.text import named

_RECORD = "_record"
PREVIEW_COLUMNS = (
    "name", "rating", "number_of_photos_norm", "len_chars", "len_words", "has_url", "message",
)


def require_columns(
    df: DataFrame, columns: Iterable[str], error: type[Exception] = ValueError
) -> DataFrame:
    """``df`` itself, or ``error`` naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise error(f"missing columns {missing}; found {df.columns}")
    return df


def _missing_to_null(c: str) -> Column:
    cell = named(c)
    return F.when(~cell.isin(*NA_TOKENS), cell).alias(c)


def _too_long(columns: Sequence[str], sep: str) -> Column:
    """Whether a record has more fields than the header.

    The parser also reports short records; those stay, padded with nulls. Separators count unless
    they are in a quoted field, and only a quote at the start of a field opens one. Doubled quotes
    stand for themselves inside such a field and say nothing elsewhere, so they go first.
    """
    single = F.replace(F.col(_RECORD), F.lit('""'), F.lit(""))
    bare = F.regexp_replace(single, rf'(^|{re.escape(sep)})"[^"]*+"', "$1")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    # Spark refuses to read the record alone, so name a column too; this part is always true
    first = named(columns[0])
    return F.coalesce(fields > len(columns), F.lit(False)) & (
        first.isNull() | (F.length(first) >= 0)
    )


def _csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """Every column as a string, in header order, and the text of irregular records."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _RECORD)])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        .csv(paths)
    )


def _headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str] | str]:
    """Which files start with each distinct header; ``path`` itself when all have the same one. A
    file without any line that is not blank has no header and no rows.

    The driver sees the distinct headers, and names of files only if there are several.
    """
    try:
        first = _inspect(spark, path).filter("header IS NOT NULL")
        found = [r[0] for r in first.select("header").distinct().collect()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no input at {path}") from e
        raise
    if not found:
        raise ValueError(f"no header in {path}")
    if len(found) == 1:
        return {found[0]: path}
    groups: dict[str, list[str]] = defaultdict(list)
    for f in first.collect():
        groups[f.header].append(unquote(f.path))
    return {h: sorted(paths) for h, paths in sorted(groups.items())}


def _read(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str,
    needed: Iterable[str],
    long_rows: str,
    multi_line: bool,
    error: type[Exception] = ValueError,
) -> DataFrame:
    """Every file by its own header; columns that a file lacks are null."""
    frames, needed = [], list(needed)
    for header, paths in _headers(spark, path).items():
        columns = _columns_of(header, sep)
        missing = [c for c in needed if c not in columns]
        if missing:
            raise error(f"missing columns {missing} in {paths}; found {list(columns)}")
        df = _csv(spark, paths, columns, sep, multi_line=multi_line)
        long = _too_long(columns, sep)
        if long_rows == "skip":
            df = df.filter(~long)
        else:
            fail = F.raise_error(F.concat(F.lit("too many fields: "), F.col(_RECORD)))
            df = df.filter(F.when(long, fail.cast("boolean")).otherwise(F.lit(True)))
        frames.append(df.select(*(_missing_to_null(c) for c in columns)))
    return _union(frames)


def read_reviews(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool = True,
    error: type[Exception] = ValueError,
) -> DataFrame:
    """A piped review table, all strings; files of a folder may differ in their headers.

    A byte-order mark is dropped, records with too many fields are skipped, short ones are
    padded, and the usual tokens for "missing" become null. ``multi_line`` lets quoted
    fields hold line ends, which keeps one file in one task; turn it off for files
    without them and Spark splits the files.
    """
    return _read(spark, path, "|", REVIEW_COLUMNS, "skip", multi_line, error)


def read_labeled(
    spark: SparkSession,
    path: str | Sequence[str],
    text_col: str = "message",
    label_col: str = "label",
    multi_line: bool = True,
) -> DataFrame:
    """A comma-separated labelled table; a record with too many fields is an error."""
    return _read(spark, path, ",", (text_col, label_col), "fail", multi_line)


def _inspect(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """One row per file that is not empty: whether it is UTF-8, and its first line that is not blank,
    null if there is none."""
    lines = spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.min_by(
            F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
                F.decode(F.col("value").cast("binary"), "ISO-8859-1")
            ),
            F.when(F.trim("value") != "", F.struct("start", "line")),
        ).alias("header"),
    )


def _columns_of(header: str | None, sep: str) -> tuple[str, ...]:
    names = next(csv.reader([(header or "").lstrip("﻿")], delimiter=sep), [])
    columns, seen = [], set()
    for i, name in enumerate(names):
        base = name = name or f"Unnamed: {i}"
        n = 0
        while name.lower() in seen:
            n += 1
            name = f"{base}.{n}"
        seen.add(name.lower())
        columns.append(name)
    return tuple(columns)


def _files_with_long_rows(df: DataFrame, columns: Sequence[str], sep: str) -> set[str]:
    long = df.withColumn("_path", F.col("_metadata.file_path")).filter(_too_long(columns, sep))
    return {unquote(r[0]) for r in long.select("_path").distinct().collect()}


def _open(
    spark: SparkSession, path: str, sep: str, encoding: str, multi_line: bool
) -> tuple[list[DataFrame], list[str]]:
    """A frame per distinct header, and the files that fit none.

    Two distributed passes sort the files out; the driver sees one line per file (as it
    does when it lists them) and makes one reader per distinct header, not per file.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    # a scan passes over files without a byte, which Spark has listed all the same
    listed = spark.read.text(path).inputFiles()
    left_out = {re.sub("^file:/+", "file:/", unquote(f)) for f in listed}
    for f in _inspect(spark, path).collect():
        if f.header is None:
            continue
        left_out.discard(re.sub("^file:/+", "file:/", unquote(f.path)))
        fits = encoding != "UTF-8" or f.utf8
        groups[f.header, encoding if fits else "ISO-8859-1", sep].append(unquote(f.path))

    frames = []
    while groups:
        (header, used, by), paths = groups.popitem()
        columns = _columns_of(header, by)
        df = _csv(spark, paths, columns, by, used, multi_line)
        bad = _files_with_long_rows(df, columns, by)
        good = [p for p in paths if p not in bad]
        if bad and used == encoding and by != ";":
            groups[header, encoding, ";"].extend(sorted(bad))
        else:
            left_out |= bad
        if good:
            frame = _csv(spark, good, columns, by, used, multi_line)
            name = F.col("_metadata.file_name").alias("__source_file")
            frames.append(frame.select(*(_missing_to_null(c) for c in columns), name))
    return frames, sorted(left_out)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_with_fallback(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """A CSV table whose encoding and separator may differ from what is expected.

    A file that is not valid UTF-8 is read as Latin-1; one with a record longer than its
    header is read with ``;`` instead. When that does not fit either, or the file is
    Latin-1, it is an error.
    """
    try:
        frames, left_out = _open(spark, path, sep, encoding, multi_line)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no input at {path}") from e
        raise
    if left_out:
        raise ValueError(f"no header, or records that do not fit it, in {left_out}")
    return _union(frames).drop("__source_file")


def load_raw_reviews(
    spark: SparkSession, folder: str, sep: str = ",", multi_line: bool = True
) -> DataFrame:
    """Every ``*.csv`` of a folder in one frame, read as by :func:`read_with_fallback`, with
    ``__source_file``. Files that cannot be read are left out with a warning, columns a file
    lacks are null, and no file at all gives an empty frame.
    """
    try:
        frames, left_out = _open(spark, f"{folder.rstrip('/')}/*.csv", sep, "UTF-8", multi_line)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        warnings.warn(f"no CSV files in {folder}", stacklevel=2)
        frames, left_out = [], []
    if left_out:
        warnings.warn(f"left out, no header or records that do not fit it: {left_out}", stacklevel=2)
    return _union(frames) if frames else spark.createDataFrame([], T.StructType([]))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error") -> None:
    """Header, minimal quoting, no trimming; null and ``""`` both as nothing."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_reviews(
    df: DataFrame, path: str, fmt: DumpFormat = DumpFormat(), mode: str = "error"
) -> None:
    """The review columns as a piped table."""
    require_columns(df, REVIEW_COLUMNS)
    write_csv(df.select(*REVIEW_COLUMNS), path, sep=fmt.csv_separator, mode=mode)


def preview(df: DataFrame) -> DataFrame:
    """The preview columns ``df`` has, in their fixed order."""
    return df.select(*(c for c in PREVIEW_COLUMNS if c in df.columns))


def write_preview(df: DataFrame, path: str, mode: str = "error") -> bool:
    """Write :func:`preview`; nothing is written for an empty frame or without columns."""
    out = preview(df)
    if not out.columns or out.isEmpty():
        return False
    write_csv(out, path, mode=mode)
    return True


def write_metrics(metrics: DataFrame, path: str, mode: str = "error") -> None:
    """A one-row metrics frame as a JSON document."""
    metrics.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)
