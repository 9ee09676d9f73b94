"""Text cleaning as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewlib.functions import patterns as P


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _sub(c: Column, pattern: str, replacement: str, flags: str = "") -> Column:
    return F.regexp_replace(c, F.lit(P.unicode(pattern, flags)), F.lit(replacement))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _around(c: Column, mark: str) -> Column:
    """One blank on each side of ``mark``. Most texts have no mark, and a byte search tells
    that much faster than the pattern does."""
    spaced = _sub(c, rf"[{P.WS}]*{re.escape(mark)}[{P.WS}]*", f" {mark} ")
    return F.when(F.contains(c, F.lit(mark)), spaced).otherwise(c)


def _filled(c: Column | str) -> Column:
    return F.coalesce(_column(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim Unicode whitespace at both ends (Spark's own ``trim`` takes only spaces)."""
    return F.btrim(_column(c), F.lit(P.WS_CHARS))


def _collapse(c: Column) -> Column:
    return _sub(c, P.SPACES, " ")


def basic_clean(c: Column | str) -> Column:
    """Web addresses out, whitespace to single spaces, lower case, trimmed; null to ``""``."""
    return strip(F.lower(_collapse(_sub(strip(_filled(c)), P.WEB_URL, " "))))


def remove_emojis(c: Column | str) -> Column:
    return _sub(_filled(c), f"(?={P.EMOJI_RANGE}){P.EMOJI}", "")


def clean_message(c: Column | str, strip_emojis: bool = True) -> Column:
    """Clean a review message: emojis, slashes, sub-rating block, links, whitespace.

    The order matters: slashes are spaced before links are cut, so ``http://x.y`` leaves
    ``/ / x.y`` behind.
    """
    s = remove_emojis(c) if strip_emojis else _filled(c)
    s = _let(s, lambda t: _around(t, "/"))
    s = _sub(s, P.SUBRATING_BLOCK, "", "i")
    s = _sub(s, P.ANY_URL, " ")
    return strip(_collapse(s))


def _nfkc_udf():
    # a local function is shipped to the workers itself, so they need not have this package
    def normalize(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return F.pandas_udf(normalize, StringType())


def nfkc(c: Column | str) -> Column:
    """NFKC form. Spark has no built-in for it, so text goes through an Arrow UDF, but
    only text with a character that could change; the rest travels as null."""
    c = _column(c)
    changes = c.rlike(f"[^{P.NFKC_STABLE}]")
    return F.coalesce(_nfkc_udf()(F.when(changes, c)), c)


def blank_links(c: Column | str) -> Column:
    """Links, mentions and hashtags to spaces."""
    s = _column(c)
    for pattern in (P.ANY_URL, P.MENTION, P.HASHTAG):
        s = _sub(s, pattern, " ")
    return s


def clean_model_text(df: DataFrame, text: str) -> DataFrame:
    """``df`` with links, mentions and hashtags of ``text`` to spaces, NFKC, trimmed. Null
    stays null. Two projections, since NFKC uses its input more than once."""
    return df.withColumn(text, blank_links(text)).withColumn(text, strip(nfkc(text)))


def text_length(c: Column | str) -> Column:
    """Length in code points, 0 for null."""
    return F.length(_filled(c))


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words, 0 for null."""
    return F.regexp_count(_filled(c), F.lit(P.unicode(f"[^{P.WS}]+")))


def has_url(c: Column | str) -> Column:
    return F.coalesce(_column(c).rlike(P.unicode(P.HAS_URL, "i")), F.lit(False))


def normalize_dump(c: Column | str) -> Column:
    """Line ends to LF and one space on each side of every separator."""
    lf = F.replace(_column(c), F.lit("\r\n"), F.lit("\n"))
    return _around(F.replace(lf, F.lit("\r"), F.lit("\n")), "|")


def clean_dump_message(c: Column | str, fmt: P.DumpFormat = P.DumpFormat()) -> Column:
    """Drop the format's noise, squeeze blanks and empty lines, trim."""
    s = _column(c)
    for pattern in fmt.noise:
        s = _sub(s, pattern, "", "is")
    s = _sub(s, r"[ \t]+", " ")
    return strip(_sub(s, r"\n{2,}", "\n"))


def sanitize_field(c: Column | str) -> Column:
    """Keep the CSV separator out of a field."""
    return strip(F.replace(_column(c), F.lit("|"), F.lit(" / ")))


def flatten_comment(c: Column | str) -> Column:
    """A comment on one line, trimmed."""
    return strip(F.replace(_column(c), F.lit("\n"), F.lit(" ")))
