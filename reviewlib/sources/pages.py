"""Whole texts of elements of stored web pages, found by balancing their tags.

A page is cut into tokens: tags, runs of text, and a lone ``<``. Comments, scripts and style
sheets are removed first, since their content is not markup and may hold ``</div>``. A fold over
the tokens keeps the depth of the wanted tag and a stack of the wanted elements still open; an
element closes at the end tag that brings the depth back to where it opened, so elements may
nest, in each other or in other elements of the same tag. End tags with no open element are
ignored; elements still open at the end of the page close there. The attribute is read anywhere
in the start tag, quoted either way or not at all, and must equal the value (as an XPath
``[@class='x']`` does).

An element's text is the text of everything inside it, as a browser shows it on one line: tags
dropped, block-level tags taken as line breaks, the entities below decoded, line breaks and other
white space runs made one space, trimmed. Everything is a column expression: no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlib.functions.text import strip

# HTML elements that a browser lays out as blocks, so their tags break lines.
BLOCK_TAGS = (
    "address article aside blockquote br dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul"
).split()
# Entities decoded in texts, ``&amp;`` last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&")]

_RAW = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_TOKENS = r"<[A-Za-z/!?][^<>]*>|[^<]+|<"
# White space of markup (ASCII, and the four separators), as a class body of a pattern.
_SPACE = r" \t\n\x0b\x0c\r\x1c-\x1f"
_TAG = r"^</?[A-Za-z][^>]*>$"


def _escape(value: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in value)


def tokens(html: Column) -> Column:
    """Tags, text runs and lone ``<`` of a page, in order; comments, scripts and styles removed."""
    clean = F.regexp_replace(F.coalesce(html, F.lit("")), F.lit(_RAW), F.lit(""))
    return F.regexp_extract_all(clean, F.lit(_TOKENS), F.lit(0))


def _piece(token: Column) -> Column:
    """What a token adds to a text: a line break for a block-level tag, nothing for another tag,
    the decoded text otherwise."""
    blocks = "|".join(BLOCK_TAGS)
    block = token.rlike(rf"(?i)^</?({blocks})([{_SPACE}/][^>]*)?>$")
    decoded = token
    for entity, char in ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(token.rlike(_TAG), F.when(block, F.lit("\n")).otherwise(F.lit(""))).otherwise(decoded)


def spans(toks: Column, tag: str, attribute: str | None, value: str | None) -> Column:
    """(start, end) token positions (from 1) of the wanted elements, by start."""
    name = _escape(tag)
    opens = rf"(?is)^<{name}([{_SPACE}/][^>]*)?>$"
    closes = rf"(?is)^</{name}[{_SPACE}]*>$"
    if attribute is not None:
        v, a = _escape(value or ""), _escape(attribute)
        has = rf"""(?is)^<{name}[{_SPACE}](.*[{_SPACE}])?{a}[{_SPACE}]*=[{_SPACE}]*("{v}"|'{v}'|{v}(?=[{_SPACE}/>])).*$"""
    step_t = "struct<depth:int,open:array<struct<start:int,depth:int>>,done:array<struct<start:int,end:int>>>"
    start = F.struct(
        F.lit(0).alias("depth"),
        F.array().cast("array<struct<start:int,depth:int>>").alias("open"),
        F.array().cast("array<struct<start:int,end:int>>").alias("done"),
    ).cast(step_t)
    indexed = F.arrays_zip(toks.alias("t"), F.sequence(F.lit(1), F.greatest(F.size(toks), F.lit(1))).alias("i"))
    indexed = F.slice(indexed, 1, F.size(toks))

    def step(state: Column, item: Column) -> Column:
        t, i = item["t"], item["i"]
        depth, open_, done = state["depth"], state["open"], state["done"]
        is_open = t.rlike(opens)
        self_closing = t.rlike(rf"/[{_SPACE}]*>$")
        is_close = t.rlike(closes)
        matched = F.lit(True) if attribute is None else t.rlike(has)
        last = F.element_at(open_, -1)
        closing = is_close & (F.size(open_) > 0) & (last["depth"] == depth)
        pushed = F.concat(open_, F.array(F.struct(i.alias("start"), (depth + 1).alias("depth"))))
        new_depth = (
            F.when(is_open & ~self_closing, depth + 1)
            .when(is_close & (depth > 0), depth - 1)
            .otherwise(depth)
        )
        new_open = (
            F.when(is_open & matched & ~self_closing, pushed)
            .when(closing, F.slice(open_, 1, F.size(open_) - 1))
            .otherwise(open_)
        )
        new_done = (
            F.when(closing, F.concat(done, F.array(F.struct(last["start"].alias("start"), i.alias("end")))))
            .when(is_open & matched & self_closing, F.concat(done, F.array(F.struct(i.alias("start"), (i + 1).alias("end")))))
            .otherwise(done)
        )
        return F.struct(new_depth.alias("depth"), new_open.alias("open"), new_done.alias("done")).cast(step_t)

    end = F.size(toks) + 1

    def finish(state: Column) -> Column:
        unclosed = F.transform(state["open"], lambda o: F.struct(o["start"].alias("start"), end.alias("end")))
        return F.array_sort(F.concat(state["done"], unclosed))

    return F.aggregate(indexed, start, step, finish)


def elements(
    html: Column | str,
    tag: str = "div",
    attribute: str | None = "class",
    value: str | None = None,
    max_elements: int | None = None,
) -> Column:
    """Texts of a page's ``<tag attribute="value">`` elements (every ``tag`` element if
    ``attribute`` is None), in the order of their start tags: whole, nested ones too, on one
    line, trimmed; blank ones dropped; all or the first ``max_elements``. A null page gives null."""
    page = F.col(html) if isinstance(html, str) else html
    toks = tokens(page)
    pieces = F.transform(toks, _piece)
    found = spans(toks, tag, attribute, value)
    texts = F.transform(
        found,
        lambda s: strip(
            F.regexp_replace(
                F.array_join(F.slice(pieces, s["start"] + 1, F.greatest(s["end"] - s["start"] - 1, F.lit(0))), ""),
                F.lit(rf"[{_SPACE}]+"),
                F.lit(" "),
            )
        ),
    )
    kept = F.filter(texts, lambda t: t != "")
    kept = F.when(page.isNotNull(), kept)
    return kept if max_elements is None else F.slice(kept, 1, max_elements)
