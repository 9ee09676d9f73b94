"""Column expressions; everything here is built-in Spark SQL but one Arrow UDF (NFKC)."""

from reviewlib.functions.ratings import (
    coerce_rating,
    extract_rating_text,
    message_ratings,
    normalize_photos,
    parse_rating,
    rating_label,
    rating_median,
)
from reviewlib.functions.text import (
    basic_clean,
    blank_links,
    clean_dump_message,
    clean_message,
    clean_model_text,
    flatten_comment,
    has_url,
    nfkc,
    normalize_dump,
    remove_emojis,
    sanitize_field,
    strip,
    text_length,
    word_count,
)

__all__ = [
    "basic_clean",
    "blank_links",
    "clean_dump_message",
    "clean_message",
    "clean_model_text",
    "coerce_rating",
    "extract_rating_text",
    "flatten_comment",
    "has_url",
    "message_ratings",
    "nfkc",
    "normalize_dump",
    "normalize_photos",
    "parse_rating",
    "rating_label",
    "rating_median",
    "remove_emojis",
    "sanitize_field",
    "strip",
    "text_length",
    "word_count",
]
