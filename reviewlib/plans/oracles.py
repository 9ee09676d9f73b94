"""DuckDB SQL for the registered queries, written apart from the Spark code: it joins
dumps where Spark does not, and ranks whole classes where Spark compares cut-offs."""

from __future__ import annotations

from reviewlib.functions import patterns as P
from reviewlib.plans import views
from reviewlib.plans.queries import FLATTEN_MAX

ORACLES: dict[str, str] = {}

_VIEWS = {
    "reviews": views.REVIEWS,
    "comments": views.COMMENTS,
    "mini_dumps": views.MINI_DUMPS,
    "sentences": views.SENTENCES,
    "predictions": views.PREDICTIONS,
}


# -- SQL fragments ---------------------------------------------------------------------


# RE2 has no Unicode \\s: the whitespace set spelled out.
_WS = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

# Ratings, links and headers, stated here once more so that a slip on either side shows.
_DUMP_RATING = r"(\d+(?:[.,]\d+)?) */ *5\b"
_MESSAGE_RATING = rf"(\d+(?:[.,]\d+)?)[{_WS}]*/[{_WS}]*5"
_FIRST_NUMBER = r"(\d+(?:[.,]\d+)?)"
_SUBRATINGS = rf"Comida:[{_WS}]*\d+(?:[.,]\d+)?[{_WS}]*/[{_WS}]*5[^\n]*\n?\z"
_LINK = rf"http[^{_WS}]+"
_WEB_LINK = rf"https?://[^{_WS}]+"
# the whole header, name first, as one pattern
_HEADER = (
    rf"(?i)([^|\n]+?)[{_WS}]+(?:Local Guide·[{_WS}]*)?(\d+)[{_WS}]+avaliaç(?:ões|ão)"
    rf"(?:·(\d+)[{_WS}]+fotos)?"
)
_NOISE = (
    "Passe o cursor para reagir",
    rf"Ofner[{_WS}]*-[{_WS}]*Perdizes[{_WS}]*\(proprietário\)[^\n]*",
)


def _q(s: str) -> str:
    return "'" + s.replace(P.WS, _WS).replace("'", "''") + "'"


def _sub(e: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({e}, {_q(pattern)}, {_q(to)}, '{flags}')"


def _strip(e: str) -> str:
    return f"trim({e}, {_q(P.WS_CHARS)})"


def _number(e: str) -> str:
    return f"TRY_CAST(replace({e}, ',', '.') AS DOUBLE)"


def _filled(e: str) -> str:
    return f"coalesce({e}, '')"


def _basic_clean(e: str) -> str:
    return _strip(f"lower({_sub(_sub(_strip(_filled(e)), _WEB_LINK, ' '), P.SPACES, ' ')})")


def _clean_message(e: str, emojis: bool = False) -> str:
    s = _filled(e) if emojis else _sub(_filled(e), P.EMOJI, "")
    s = _sub(s, rf"[{P.WS}]*/[{P.WS}]*", " / ")
    s = _sub(s, _SUBRATINGS, "", "gi")
    s = _sub(s, _LINK, " ")
    return _strip(_sub(s, P.SPACES, " "))


def _parse_rating(e: str) -> str:
    v = _number(f"regexp_extract({_filled(e)}, {_q(_FIRST_NUMBER)}, 1)")
    return (
        f"CASE WHEN {v} <= 5 THEN {v} WHEN {v} <= 100 THEN {v} / 20.0::DOUBLE "
        f"WHEN {v} IS NOT NULL THEN 5.0::DOUBLE END"
    )


def _message_ratings(e: str) -> str:
    found = f"regexp_extract_all({_filled(e)}, {_q(_MESSAGE_RATING)}, 1)"
    return (
        f"list_filter(list_transform({found}, lambda z: {_number('z')}), "
        "lambda v: v BETWEEN 0 AND 5)"
    )


def _median(e: str) -> str:
    return f"CAST(list_median({e}) AS DOUBLE)"


def _label(v: str) -> str:
    return (
        f"CASE WHEN {v} >= 4 THEN 'positive' WHEN {v} <= 2 THEN 'negative' "
        f"WHEN {v} IS NOT NULL THEN 'neutral' END"
    )


def _coerce(e: str) -> str:
    ok = f"regexp_matches({e}, {_q(P.NUMERIC)}, 'i')"
    return f"CASE WHEN {ok} THEN TRY_CAST({_strip(e)} AS DOUBLE) END"


def _photos(e: str) -> str:
    s = _sub(_strip(_filled(e)), r"\.0+\z", "")
    return f"CASE WHEN regexp_matches({s}, '^[0-9]+\\z') THEN {s} ELSE '0' END"


def _words(e: str) -> str:
    return f"CAST(len(regexp_extract_all({_filled(e)}, {_q(f'[^{P.WS}]+')})) AS INTEGER)"


def _normalize_dump(e: str) -> str:
    return _sub(_sub(e, r"\r\n?", "\n"), rf"[{P.WS}]*\|[{P.WS}]*", " | ")


def _headers(e: str, k: int) -> str:
    return f"regexp_extract_all({e}, {_q(_HEADER)}, {k})"


def _dump_rating(e: str) -> str:
    found = f"regexp_extract_all({e}, {_q(_DUMP_RATING)}, 1)"
    found = f"list_transform({found}, lambda z: {_number('z')})"
    return (
        f"CASE WHEN len({found}) > 0 THEN printf('%.1f', list_sum({found}) / len({found})) "
        "|| '/5' ELSE '' END"
    )


def _clean_dump(e: str) -> str:
    for pattern in _NOISE:
        e = _sub(e, pattern, "", "gis")
    return _strip(_sub(_sub(e, r"[ \t]+", " "), r"\n{2,}", "\n"))


def _sanitize(e: str) -> str:
    return _strip(f"replace({e}, '|', ' / ')")


def _tokens(e: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"translate({_filled(e)}, '{upper}', '{upper.lower()}')"
    split = f"string_split_regex({_sub(low, P.PUNCTUATION, '')}, '[\\t-\\r ]+')"
    return f"list_filter({split}, lambda t: t <> '')"


def _null_tokens(e: str) -> str:
    tokens = ", ".join(map(_q, P.NA_TOKENS))
    return f"CASE WHEN {e} NOT IN ({tokens}) THEN {e} END"


# -- shared subqueries -----------------------------------------------------------------

_FLAT = f"""SELECT source, doc_id, comment FROM (
  SELECT source, doc_id, {_strip("replace(comment, chr(10), ' ')")} AS comment FROM comments)
WHERE comment <> ''"""


def _parsed(keys: str, dumps: str) -> str:
    """Reviews of (keys, dump) rows."""
    text = _normalize_dump("dump")
    return f"""SELECT {keys}, review_no,
  {_sanitize(_strip("nm"))} AS name, {_dump_rating("body")} AS rating,
  {_sanitize("ph")} AS number_of_photos, {_sanitize(_clean_dump("body"))} AS message
FROM (SELECT {keys}, review_no, nm, coalesce(ph, '') AS ph,
        {_strip("ltrim(raw, ' |')")} AS body
      FROM (SELECT {keys}, unnest(range(1, len(n) + 1)) AS review_no, unnest(n) AS nm,
              unnest(p) AS ph, unnest(b[2:]) AS raw
            FROM (SELECT {keys}, {_headers("t", 1)} AS n, {_headers("t", 3)} AS p,
                    string_split_regex(t, {_q(_HEADER)}) AS b
                  FROM (SELECT {keys}, {text} AS t FROM ({dumps})))))"""


_SOURCE_DUMPS = f"""SELECT source, string_agg(comment, ' | ' ORDER BY doc_id) AS dump
FROM (SELECT source, doc_id, {_strip("comment")} AS comment FROM comments) GROUP BY source"""
_FLAT_DUMPS = f"""SELECT source, string_agg(comment, ' | ' ORDER BY doc_id) AS dump
FROM ({_FLAT}) GROUP BY source"""

_LABELED = f"""SELECT review_id, name, rating, number_of_photos, message, rating_num, label FROM (
  SELECT *, {_label("rating_num")} AS label FROM (
    SELECT review_id, name, rating, number_of_photos, message,
      coalesce({_parse_rating("rating")}, {_median(_message_ratings("SEARCHED"))}) AS rating_num
    FROM (SELECT review_id, name, rating, number_of_photos, message AS raw,
            {_clean_message("message")} AS message FROM reviews)))
WHERE length(message) > 0 AND label IS NOT NULL"""
_LABELED_CLEAN = _LABELED.replace("SEARCHED", "message")
_LABELED_RAW = _LABELED.replace("SEARCHED", "raw")

_EDA = f"""SELECT review_id, name, rating, number_of_photos, message, rating_raw,
  {_photos("number_of_photos")} AS number_of_photos_norm,
  CAST(length(message) AS INTEGER) AS len_chars, {_words("message")} AS len_words,
  coalesce(regexp_matches(message, {_q('https?://')}, 'i'), false) AS has_url
FROM (SELECT review_id, {_strip(_filled("name"))} AS name, {_coerce("rating")} AS rating,
        number_of_photos, {_strip(_filled("message"))} AS message, rating AS rating_raw
      FROM reviews)"""


def _prepared(fields: tuple[str, ...], columns: str) -> str:
    cleaned = []
    for f in fields:
        s = _strip(_filled(f))
        if f == "number_of_photos":
            s = f"CASE WHEN {s} = '' THEN '0' ELSE {s} END"
        cleaned.append(f"{_basic_clean(s)} AS {f}_clean")
    lengths = ", ".join(f"CAST(length({f}_clean) AS INTEGER) AS {f}_length" for f in fields)
    return (
        f"SELECT *, {lengths} FROM (SELECT {columns}, {', '.join(cleaned)} FROM reviews)"
    )


_QUOTAS = """SELECT label, n, n_train, n_val, n - n_train - n_val AS n_test FROM (
  SELECT *, base2 + CASE WHEN row_number() OVER (ORDER BY share2 - base2 DESC, label)
                          <= val - sum(base2) OVER () THEN 1 ELSE 0 END AS n_val
  FROM (SELECT *, CAST(floor(share2) AS BIGINT) AS base2 FROM (
    SELECT *, (n - n_train) / CAST(sum(n - n_train) OVER () AS DOUBLE) * val AS share2
    FROM (
      SELECT *, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, label)
                             <= train - sum(base) OVER () THEN 1 ELSE 0 END AS n_train
      FROM (SELECT *, CAST(floor(share) AS BIGINT) AS base FROM (
        SELECT *, n / CAST(total AS DOUBLE) * train AS share FROM (
          SELECT *, held - CAST(ceil(held * 0.5::DOUBLE) AS BIGINT) AS val, total - held AS train
          FROM (
            SELECT label, n, total, CAST(ceil(total * 0.3::DOUBLE) AS BIGINT) AS held FROM (
              SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
              FROM sentences GROUP BY label)))))))))"""

_SPLIT = f"""SELECT s.doc_id, s.message, s.label,
  CASE WHEN nth <= n_train THEN 'train' WHEN nth <= n_train + n_val THEN 'val' ELSE 'test' END
  AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || doc_id)) AS nth
      FROM sentences) AS s JOIN ({_QUOTAS}) AS q ON s.label = q.label"""

_VOCABULARY = f"""SELECT token, CAST(nth + 1 AS INTEGER) AS token_id, n FROM (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token DESC) AS nth FROM (
    SELECT token, count(*) AS n
    FROM (SELECT unnest({_tokens("message")}) AS token FROM ({_SPLIT}) WHERE split = 'train')
    GROUP BY token))
WHERE nth <= 19998"""

_IDS = "CASE label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END"
_NAMES = "('negative'), ('neutral'), ('positive')"
_PER_CLASS = f"""SELECT c.label,
  count(*) FILTER (p.label = c.label AND p.pred = c.label) AS hits,
  count(*) FILTER (p.pred = c.label) AS predicted,
  count(*) FILTER (p.label = c.label) AS support
FROM (VALUES {_NAMES}) AS c(label), predictions AS p GROUP BY c.label"""
_SCORES = f"""SELECT label, hits / CAST(nullif(predicted, 0) AS DOUBLE) AS p0,
  hits / CAST(nullif(support, 0) AS DOUBLE) AS r0,
  2 * hits / CAST(nullif(predicted + support, 0) AS DOUBLE) AS f0, support, hits
FROM ({_PER_CLASS})"""
_REPORT = f"""SELECT label, coalesce(p0, 0) AS precision, coalesce(r0, 0) AS recall,
  coalesce(f0, 0) AS f1, support, hits FROM ({_SCORES})"""


def _add(name: str, sql: str) -> None:
    """Register ``sql`` with the views it names."""
    needed = [v for v in _VIEWS if f" {v}" in sql.replace("\n", " ")]
    ctes = ", ".join(f"{v} AS ({_VIEWS[v]})" for v in needed)
    ORACLES[name] = f"WITH {ctes} {sql}" if ctes else sql


# -- dumps -----------------------------------------------------------------------------

_add("normalize_dump", f"SELECT doc_id, {_normalize_dump('dump')} AS dump FROM mini_dumps")
_add(
    "find_headers",
    f"""SELECT doc_id, CAST(header_no AS INTEGER) AS header_no, {_strip("nm")} AS name, reviews,
  coalesce(photos, '') AS photos
FROM (SELECT doc_id, unnest(range(0, len(n))) AS header_no, unnest(n) AS nm,
        unnest(r) AS reviews, unnest(p) AS photos
      FROM (SELECT doc_id, {_headers("t", 1)} AS n, {_headers("t", 2)} AS r,
              {_headers("t", 3)} AS p
            FROM (SELECT doc_id, {_normalize_dump("dump")} AS t FROM mini_dumps)))""",
)
_add("extract_rating_text", f"SELECT doc_id, {_dump_rating('dump')} AS rating FROM mini_dumps")
_add(
    "clean_dump_message",
    f"SELECT doc_id, {_clean_dump(_normalize_dump('dump'))} AS message FROM mini_dumps",
)
_add("sanitize_field", f"SELECT doc_id, {_sanitize('dump')} AS field FROM mini_dumps")
_add("parse_dumps", _parsed("doc_id", "SELECT doc_id, dump FROM mini_dumps"))
_add("parse_comments", _parsed("source", _SOURCE_DUMPS))
_add(
    "flatten_comments",
    f"""SELECT source, doc_id, comment FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM ({_FLAT}))
WHERE nth <= {FLATTEN_MAX}""",
)
# Elements of pages, by a walk over tokens that carries the depth of the tag and a stack of open
# wanted elements, one token a step (a recursive query). Stated here once more: markup white
# space, block-level tags, entities.
_SP = r" \t\n\x0b\x0c\r\x1c-\x1f"
_BLOCKS = (
    "address|article|aside|blockquote|br|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|"
    "form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|summary|table|tbody|td|tfoot|"
    "th|thead|tr|ul"
)
_DECODED = "t"
for _entity, _char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                       ("&nbsp;", "\xa0"), ("&amp;", "&")]:
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"


def _elements(tag: str, attribute: str | None = None, value: str | None = None) -> str:
    wanted = (
        "true"
        if attribute is None
        else f"""regexp_matches(t, '(?is)^<{tag}[{_SP}](.*[{_SP}])?{attribute}[{_SP}]*=[{_SP}]*("{value}"|''{value}''|{value}[{_SP}/>])')"""
    )
    return f"""WITH RECURSIVE tok AS (
  SELECT page_id, unnest(toks) AS t, unnest(range(1, len(toks) + 1)) AS i, len(toks) AS n FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(coalesce(html, ''),
      '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
      '<[A-Za-z/!?][^<>]*>|[^<]+|<') AS toks FROM pages)
), kinds AS (
  SELECT page_id, i, n,
    regexp_matches(t, '(?is)^<{tag}([{_SP}/][^>]*)?>$') AND NOT regexp_matches(t, '/[{_SP}]*>$') AS opens,
    regexp_matches(t, '(?is)^</{tag}[{_SP}]*>$') AS closes,
    {wanted} AS wanted,
    CASE WHEN regexp_matches(t, '^</?[A-Za-z][^>]*>$')
      THEN CASE WHEN regexp_matches(t, '(?i)^</?({_BLOCKS})([{_SP}/][^>]*)?>$') THEN chr(10) ELSE '' END
      ELSE {_DECODED} END AS piece
  FROM tok
), walk AS (
  SELECT page_id, 0 AS i, 0 AS depth, []::STRUCT(s INTEGER, d INTEGER)[] AS stack, NULL::INTEGER AS closed,
    max(n) AS n
  FROM tok GROUP BY page_id
  UNION ALL
  SELECT w.page_id, k.i,
    CASE WHEN k.opens THEN w.depth + 1 WHEN k.closes AND w.depth > 0 THEN w.depth - 1 ELSE w.depth END,
    CASE WHEN k.opens AND k.wanted THEN list_append(w.stack, {{'s': k.i, 'd': w.depth + 1}})
      WHEN k.closes AND len(w.stack) > 0 AND w.stack[len(w.stack)].d = w.depth THEN w.stack[1:len(w.stack) - 1]
      ELSE w.stack END,
    CASE WHEN k.closes AND len(w.stack) > 0 AND w.stack[len(w.stack)].d = w.depth THEN w.stack[len(w.stack)].s END,
    w.n
  FROM walk AS w JOIN kinds AS k ON k.page_id = w.page_id AND k.i = w.i + 1
), spans AS (
  SELECT page_id, closed AS s, i AS e FROM walk WHERE closed IS NOT NULL
  UNION ALL
  SELECT page_id, unnest(stack).s AS s, n + 1 AS e FROM walk WHERE i = n AND n > 0
), texts AS (
  SELECT sp.page_id, sp.s,
    {_strip(f"regexp_replace(string_agg(k.piece, '' ORDER BY k.i), '[{_SP}]+', ' ', 'g')")} AS element
  FROM spans AS sp LEFT JOIN kinds AS k ON k.page_id = sp.page_id AND k.i > sp.s AND k.i < sp.e
  GROUP BY sp.page_id, sp.s, sp.e
)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY s) - 1 AS INTEGER) AS pos, element
FROM texts WHERE element <> ''"""


ORACLES["page_elements"] = _elements("div", "class", "ad")
ORACLES["page_articles"] = _elements("article")
_add("dump_files", _parsed("source", _FLAT_DUMPS))
_add("dump_file_pieces", _parsed("source", _FLAT_DUMPS))
_PARSE_JOB = f"""SELECT {_null_tokens("name")} AS name, {_null_tokens("rating")} AS rating,
  {_null_tokens("number_of_photos")} AS number_of_photos, {_null_tokens("message")} AS message
FROM ({_parsed("source", _FLAT_DUMPS)})"""
_add("parse_job", _PARSE_JOB)
_add("parse_job_latin1", _PARSE_JOB)

# -- cleaning --------------------------------------------------------------------------

_add("basic_clean", f"SELECT review_id, {_basic_clean('message')} AS message FROM reviews")
_add(
    "remove_emojis",
    f"SELECT review_id, {_sub(_filled('message'), P.EMOJI, '')} AS message FROM reviews",
)
_add(
    "clean_message",
    f"""SELECT review_id, {_clean_message("message")} AS message,
  {_clean_message("message", emojis=True)} AS with_emojis FROM reviews""",
)
# the view's text is its own NFKC form
_add(
    "clean_model_text",
    "SELECT review_id, "
    + _strip(_sub(_sub(_sub("message", _LINK, " "), P.MENTION, " "), P.HASHTAG, " "))
    + " AS message FROM reviews",
)
_add(
    "coerce_rating",
    f"SELECT review_id, rating AS rating_raw, {_coerce('rating')} AS rating FROM reviews",
)
_add(
    "normalize_photos",
    f"SELECT review_id, {_photos('number_of_photos')} AS number_of_photos_norm FROM reviews",
)
_ALL = "review_id, name, rating, number_of_photos, message"
_add("prepare_columns", _prepared(("number_of_photos",), _ALL))
_add("preprocess_reviews", _prepared(P.REVIEW_COLUMNS, _ALL))
_add("eda_features", _EDA)

# -- labels ----------------------------------------------------------------------------

_add("parse_rating", f"SELECT review_id, {_parse_rating('rating')} AS rating_num FROM reviews")
_add(
    "message_ratings",
    f"""SELECT review_id, CAST(i AS INTEGER) AS pos, value FROM (
  SELECT review_id, unnest(range(0, len(v))) AS i, unnest(v) AS value
  FROM (SELECT review_id, {_message_ratings("message")} AS v FROM reviews))""",
)
_add(
    "message_rating_median",
    f"SELECT review_id, {_median(_message_ratings('message'))} AS median FROM reviews",
)
_add(
    "rating_num",
    f"""SELECT review_id, coalesce({_parse_rating("rating")},
  {_median(_message_ratings(_clean_message("message")))}) AS rating_num FROM reviews""",
)
_add(
    "rating_label",
    f"SELECT review_id, {_label(_parse_rating('rating'))} AS label FROM reviews",
)
_add("label_reviews", _LABELED_CLEAN)
_add("label_reviews_raw_ratings", _LABELED_RAW)
_add(
    "label_distribution",
    f"SELECT label, count(*) AS n FROM ({_LABELED_CLEAN}) GROUP BY label",
)
_add(
    "labeling_summary",
    f"""SELECT (SELECT count(*) FROM reviews) AS rows_in,
  (SELECT count(*) FROM ({_LABELED_CLEAN})) AS rows_usable""",
)

# -- tables as files -------------------------------------------------------------------

_add(
    "read_reviews",
    f"""SELECT {_null_tokens("name")} AS name, {_null_tokens("rating")} AS rating,
  {_null_tokens("number_of_photos")} AS number_of_photos, {_null_tokens("message")} AS message
FROM reviews""",
)
_add(
    "read_irregular_reviews",
    f"""SELECT source AS name, CASE lang WHEN 'en' THEN '4/5' WHEN 'de' THEN '3/5' END AS rating,
  CAST(NULL AS VARCHAR) AS number_of_photos,
  CASE WHEN lang = 'en' THEN flat || ' | fim' WHEN lang <> 'de' THEN {_null_tokens("flat")} END
  AS message
FROM (SELECT *, {_strip("replace(text, chr(10), ' ')")} AS flat FROM documents)
WHERE lang <> 'fr'""",
)
_add(
    "read_mixed_headers",
    f"""SELECT source AS name, '4/5' AS rating, lang AS number_of_photos,
  {_null_tokens("flat")} AS message
FROM (SELECT *, replace({_strip("replace(text, chr(10), ' ')")}, '|', '/') AS flat FROM documents)""",
)
_add(
    "read_stray_quotes",
    """SELECT 'a"' || source AS name, '1' AS rating, '2' AS number_of_photos, 'x"y' AS message
FROM documents WHERE doc_id % 3 <> 0""",
)
_add("load_raw_with_blank_file", "SELECT source AS name, lang AS rating FROM documents")
_add(
    "load_raw_reviews",
    """SELECT source AS name, lang AS rating, text || ', é' AS message,
  CASE WHEN lang <> 'es' THEN CAST(n_chars AS VARCHAR) END AS chars, true AS named
FROM documents""",
)


def _read_back(sql: str, texts: tuple[str, ...], others: tuple[str, ...] = ()) -> str:
    """Columns as the CSV reader gives them: strings, missing tokens null."""
    columns = [f"{_null_tokens(c)} AS {c}" for c in texts]
    columns += [f"CAST({c} AS VARCHAR) AS {c}" for c in others]
    return f"SELECT {', '.join(columns)} FROM ({sql})"


_TEXTS = P.REVIEW_COLUMNS
_add(
    "read_labeled",
    _read_back(_LABELED_CLEAN, (*_TEXTS, "label"), ("review_id", "rating_num")),
)
_add(
    "label_job",
    _read_back(_LABELED_CLEAN, (*_TEXTS, "label"), ("rating_num",)),
)
_add(
    "preprocess_job",
    _read_back(
        _prepared(_TEXTS, _ALL),
        (*_TEXTS, *(f"{c}_clean" for c in _TEXTS)),
        tuple(f"{c}_length" for c in _TEXTS),
    ),
)
_add(
    "read_with_fallback",
    f"SELECT source, lang, {_null_tokens('text')} AS text FROM documents",
)
_PREVIEW = (
    _read_back(
        _EDA,
        ("name", "number_of_photos_norm", "message"),
        ("rating", "len_chars", "len_words", "has_url"),
    )
)
_add("write_preview", _PREVIEW)
_add("eda_job", _PREVIEW)

# -- reports ---------------------------------------------------------------------------

_add(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{'string' if i else 'bigint'}' AS dtype, "
        f"count(*) FILTER ({c} IS NULL) AS nulls "
        "FROM reviews"
        for i, c in enumerate(("review_id", *P.REVIEW_COLUMNS))
    ),
)


def _describe_text(i: int, c: str) -> str:
    return f"""SELECT {i} AS position, '{c}' AS "column",
  CAST(coalesce(sum(n), 0) AS BIGINT) AS count, count(*) AS "unique",
  first(v ORDER BY n DESC, md5(v)) AS top, max(n) AS freq, NULL::DOUBLE AS mean,
  NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50,
  NULL::DOUBLE AS q75, NULL::DOUBLE AS max
FROM (SELECT {c} AS v, count(*) AS n FROM eda WHERE {c} IS NOT NULL GROUP BY {c})"""


def _describe_number(i: int, c: str) -> str:
    q = ", ".join(f"round(quantile_cont({c}, 0.{p}), 6) AS q{p}" for p in (25, 50, 75))
    return f"""SELECT {i} AS position, '{c}' AS "column", count({c}) AS count,
  NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  {q}, CAST(max({c}) AS DOUBLE) AS max FROM eda"""


ORACLES["describe_reviews"] = f"""WITH reviews AS ({views.REVIEWS}), eda AS ({_EDA}) """ + (
    " UNION ALL ".join(
        (
            _describe_text(0, "name"),
            _describe_number(1, "rating"),
            _describe_text(2, "number_of_photos"),
            _describe_text(3, "message"),
            _describe_number(4, "len_words"),
        )
    )
)
_add(
    "rating_distribution",
    f"SELECT rating, count(*) AS n FROM ({_EDA}) WHERE rating IS NOT NULL GROUP BY rating",
)
_add(
    "words_histogram",
    f"""SELECT CAST(b AS INTEGER) AS bin, round(lo + b * CAST(hi - lo AS DOUBLE) / 30, 9) AS low,
  round(lo + (b + 1) * CAST(hi - lo AS DOUBLE) / 30, 9) AS high, coalesce(n, 0) AS n
FROM (SELECT min(len_words) AS lo, max(len_words) AS hi FROM ({_EDA})),
  (SELECT unnest(range(0, 30)) AS b) LEFT JOIN (
    SELECT least(((len_words - lo) * 30) // (hi - lo), 29) AS bb, count(*) AS n
    FROM ({_EDA}), (SELECT min(len_words) AS lo, max(len_words) AS hi FROM ({_EDA}))
    GROUP BY bb) ON b = bb""",
)
_add(
    "words_box_by_rating",
    f"""SELECT e.rating, count(*) AS n, round(any_value(q1), 9) AS q1,
  round(any_value(q2), 9) AS median, round(any_value(q3), 9) AS q3,
  least(coalesce(min(CAST(len_words AS DOUBLE)) FILTER (len_words >= q1 - 1.5 * (q3 - q1)),
    any_value(q1)), any_value(q1)) AS whisker_low,
  greatest(coalesce(max(CAST(len_words AS DOUBLE)) FILTER (len_words <= q3 + 1.5 * (q3 - q1)),
    any_value(q3)), any_value(q3)) AS whisker_high
FROM ({_EDA}) AS e JOIN (
  SELECT rating, quantile_cont(len_words, 0.25) AS q1, quantile_cont(len_words, 0.5) AS q2,
    quantile_cont(len_words, 0.75) AS q3 FROM ({_EDA}) GROUP BY rating) AS b
  ON e.rating = b.rating
GROUP BY e.rating""",
)
_add(
    "top_authors",
    f"SELECT name, count(*) AS n FROM ({_EDA}) GROUP BY name ORDER BY n DESC, name LIMIT 20",
)
_SUSPECT = f"""SELECT review_id, name, rating, len_words, has_url, message FROM ({_EDA})
WHERE len_words <= 3 OR has_url"""
_add("suspect_reviews", _SUSPECT)
_add("suspect_reviews_top", f"{_SUSPECT} ORDER BY review_id LIMIT 10")
_DUPLICATE = f"""SELECT review_id, name, rating, message FROM (
  SELECT *, count(*) OVER (PARTITION BY message) AS copies FROM ({_EDA})) WHERE copies > 1"""
_add("duplicate_messages", _DUPLICATE)
_add("duplicate_messages_top", f"{_DUPLICATE} ORDER BY message, review_id LIMIT 20")

# -- training --------------------------------------------------------------------------

_add(
    "encode_labels",
    f"SELECT doc_id, label, {_IDS} AS label_id, label AS decoded FROM sentences",
)
_add("stratified_split", f"SELECT doc_id, label, split FROM ({_SPLIT})")
_add(
    "shuffle_rows",
    """SELECT doc_id, md5('42-' || doc_id) AS key,
  row_number() OVER (ORDER BY md5('42-' || doc_id), doc_id) - 1 AS position FROM sentences""",
)
_add(
    "split_quotas",
    f"""SELECT label, n, CAST(n_train AS BIGINT) AS n_train, CAST(n_val AS BIGINT) AS n_val,
  CAST(n_test AS BIGINT) AS n_test FROM ({_QUOTAS})""",
)
_add(
    "class_weights",
    f"""SELECT label, {_IDS} AS label_id, n,
  round(CAST(sum(n) OVER () AS BIGINT) / CAST(3 * n AS DOUBLE), 9) AS weight
FROM (SELECT label, count(*) AS n FROM ({_SPLIT}) WHERE split = 'train' GROUP BY label)""",
)
_add("build_vocabulary", _VOCABULARY)


def _similar(rows: str) -> str:
    """All pairs of TF-IDF vectors of ``rows`` (``id``, ``message``) with a cosine of 0.8 or more,
    by joining every term with every other vector that has it."""
    return f"""SELECT a.id AS a, b.id AS b, round(sum(a.w * b.w), 9) AS cosine FROM (
  SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS w FROM (
    SELECT id, term, tf * (ln((n + 1.0) / (df + 1.0)) + 1) AS raw FROM (
      SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)
      GROUP BY id, term) AS c
    JOIN (SELECT term, count(DISTINCT id) AS df FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)
      GROUP BY term) USING (term)
    CROSS JOIN (SELECT count(DISTINCT id) AS n FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)))) AS a
JOIN (
  SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS w FROM (
    SELECT id, term, tf * (ln((n + 1.0) / (df + 1.0)) + 1) AS raw FROM (
      SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)
      GROUP BY id, term) AS c
    JOIN (SELECT term, count(DISTINCT id) AS df FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)
      GROUP BY term) USING (term)
    CROSS JOIN (SELECT count(DISTINCT id) AS n FROM (
        SELECT id, unnest({_tokens("message")}) AS term FROM ({rows}) WHERE id IS NOT NULL)))) AS b
  ON a.term = b.term AND a.id < b.id
GROUP BY a.id, b.id HAVING round(sum(a.w * b.w), 9) >= 0.8"""


_add("similar_reviews", _similar("SELECT review_id AS id, message FROM reviews"))
_add("similar_authors", _similar(f"SELECT lower({_strip('name')}) AS id, message FROM reviews"))
ORACLES["nearest_vectors"] = """SELECT query, CAST(rank AS INTEGER) AS rank, id, distance FROM (
  SELECT query, id, distance, row_number() OVER (PARTITION BY query ORDER BY distance, id) AS rank FROM (
    SELECT q.vec_id AS query, e.vec_id AS id, round(list_sum(list_transform(range(1, len(q.embedding) + 1),
      lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(q.embedding[i] AS DOUBLE))
         * (CAST(e.embedding[i] AS DOUBLE) - CAST(q.embedding[i] AS DOUBLE)))), 9) AS distance
    FROM embeddings AS q JOIN embeddings AS e ON q.vec_id <> e.vec_id
    WHERE q.vec_id % 100 = 0 AND q.embedding IS NOT NULL AND e.embedding IS NOT NULL))
WHERE rank <= 10"""
# Function words of the profiles, stated once more.
_FUNCTION = ("the of and to a in that it is was for on with as at by from or an be this which not but are "
             "his her they we you i he she").split()


def _review_delta() -> str:
    counts = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS c_{w}" for w in _FUNCTION)
    sums = ", ".join(f"sum(c_{w}) AS c_{w}" for w in _FUNCTION)
    stats = ", ".join(
        f"avg(c_{w} / total) AS mu_{w}, coalesce(stddev_samp(c_{w} / total), 0) AS sd_{w}" for w in _FUNCTION
    )

    def z(freq: str, w: str) -> str:
        return f"CASE WHEN sd_{w} > 0 THEN ({freq} - mu_{w}) / sd_{w} ELSE 0 END"

    delta = " + ".join(
        f"abs({z(f'r.c_{w} / r.total', w)} - {z(f'(a.c_{w} - r.c_{w}) / (a.total - r.total)', w)})"
        for w in _FUNCTION
    )
    r = f"""SELECT id, author, len(t) AS total, {counts} FROM (
    SELECT review_id AS id, lower({_strip('name')}) AS author, {_tokens('message')} AS t FROM reviews)
  WHERE author IS NOT NULL"""
    a = f"SELECT author, sum(total) AS total, {sums} FROM ({r}) GROUP BY author HAVING sum(total) > 0"
    return f"""SELECT r.id, r.author,
  CASE WHEN a.total - r.total > 0 THEN round(({delta}) / {len(_FUNCTION)}, 9) END AS delta
FROM ({r}) AS r JOIN ({a}) AS a USING (author) CROSS JOIN (SELECT {stats} FROM ({a})) AS s
WHERE r.total > 0"""


_add("review_delta", _review_delta())
_WEIGHTS = f"""SELECT label, n, round(CAST(sum(n) OVER () AS BIGINT) / CAST(3 * n AS DOUBLE), 9) AS weight
FROM (SELECT label, count(*) AS n FROM ({_SPLIT}) WHERE split = 'train' GROUP BY label)"""
_add(
    "train_classifier",
    f"""SELECT label, n, weight, true AS finite_intercept, true AS all_words_used FROM ({_WEIGHTS})""",
)
_add(
    "predict_proba",
    """SELECT doc_id, label, CAST(3 AS INTEGER) AS classes, true AS in_range, true AS sums_to_one
FROM sentences""",
)
_add("predict_labels", "SELECT doc_id, label, true AS pred_is_argmax FROM sentences")
_add(
    "train_metrics",
    "SELECT 'negative neutral positive' AS labels, "
    + ", ".join(
        f"max(weight) FILTER (label = '{c}') AS w_{c}" for c in ("negative", "neutral", "positive")
    )
    + f""", true AS epochs_in_range, true AS loss_finite, true AS accuracy_near_majority_or_above
FROM ({_WEIGHTS})""",
)
_add(
    "encode_sequences",
    f"""SELECT d.doc_id, array_to_string(
    list_concat(coalesce(ids, []), list_transform(range(0, 200 - len(coalesce(ids, []))),
      lambda z: 0)), ' ') AS ids
FROM sentences AS d LEFT JOIN (
  SELECT doc_id, list(coalesce(token_id, 1) ORDER BY pos) AS ids FROM (
    SELECT doc_id, unnest(range(0, len(ts))) AS pos, unnest(ts) AS word
    FROM (SELECT doc_id, ({_tokens("message")})[1:200] AS ts FROM sentences)) AS w
  LEFT JOIN ({_VOCABULARY}) AS v ON w.word = v.token GROUP BY doc_id) AS x
ON d.doc_id = x.doc_id""",
)
_add(
    "most_likely_labels",
    """SELECT doc_id, CASE WHEN p_negative >= p_neutral AND p_negative >= p_positive THEN 'negative'
  WHEN p_neutral >= p_positive THEN 'neutral' ELSE 'positive' END AS most_likely
FROM predictions""",
)

# -- scores ----------------------------------------------------------------------------

_add(
    "eval_accuracy_loss",
    """SELECT round(avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0 END), 9) AS test_acc,
  round(avg(-ln(least(greatest(CASE label WHEN 'negative' THEN p_negative
    WHEN 'neutral' THEN p_neutral ELSE p_positive END, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE))), 9)
  AS test_loss
FROM predictions""",
)
_add(
    "confusion_matrix",
    f"""SELECT c.label, count(*) FILTER (p.pred = 'negative') AS pred_negative,
  count(*) FILTER (p.pred = 'neutral') AS pred_neutral,
  count(*) FILTER (p.pred = 'positive') AS pred_positive
FROM (VALUES {_NAMES}) AS c(label) LEFT JOIN predictions AS p ON p.label = c.label
GROUP BY c.label""",
)
_add(
    "classification_report",
    f"""SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, support FROM ({_REPORT})
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
  CAST(sum(support) AS BIGINT) FROM ({_REPORT})
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM ({_REPORT})""",
)
_add(
    "classification_metrics",
    f"""SELECT round(CAST(sum(hits) AS DOUBLE) / sum(support), 9) AS accuracy,
  round(avg(f1), 9) AS macro_f1, round(sum(f1 * support) / sum(support), 9) AS weighted_f1,
  CAST(sum(support) AS BIGINT) AS n FROM ({_REPORT})""",
)
_CONFUSION = f"""SELECT c.label, count(*) FILTER (p.pred = 'negative') AS pred_negative,
  count(*) FILTER (p.pred = 'neutral') AS pred_neutral,
  count(*) FILTER (p.pred = 'positive') AS pred_positive
FROM (VALUES {_NAMES}) AS c(label) LEFT JOIN predictions AS p ON p.label = c.label
GROUP BY c.label"""
_add(
    "evaluate_job",
    f"""SELECT *, (SELECT round(avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0 END), 9)
  FROM predictions) AS accuracy FROM ({_CONFUSION})""",
)
_READ = f"""SELECT {", ".join(f"{_null_tokens(c)} AS {c}" for c in P.REVIEW_COLUMNS)} FROM reviews"""
_add(
    "eda_report_null_counts",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", 'string' AS dtype, "
        f"count(*) FILTER ({c} IS NULL) AS nulls FROM ({_READ})"
        for i, c in enumerate(P.REVIEW_COLUMNS)
    )
    + """ UNION ALL SELECT 4 AS position, '__source_file' AS "column", 'string' AS dtype,
  CAST(0 AS BIGINT) AS nulls""",
)
_add(
    "eda_report_ratings",
    f"SELECT rating, count(*) AS n FROM ({_EDA}) WHERE rating IS NOT NULL GROUP BY rating",
)
_add(
    "eda_report_authors",
    f"SELECT name, count(*) AS n FROM ({_EDA}) GROUP BY name ORDER BY n DESC, name LIMIT 20",
)
