"""Readers and writers."""

from reviewlib.sources.dumps import (
    dump_comments,
    page_elements,
    read_dump_pieces,
    read_dumps,
    write_dumps,
)
from reviewlib.sources.models import load_model, save_model
from reviewlib.sources.tables import (
    load_raw_reviews,
    preview,
    read_labeled,
    read_reviews,
    read_with_fallback,
    require_columns,
    write_csv,
    write_metrics,
    write_preview,
    write_reviews,
)

__all__ = [
    "dump_comments",
    "load_model",
    "load_raw_reviews",
    "page_elements",
    "preview",
    "read_dump_pieces",
    "read_dumps",
    "read_labeled",
    "read_reviews",
    "read_with_fallback",
    "require_columns",
    "save_model",
    "write_csv",
    "write_dumps",
    "write_metrics",
    "write_preview",
    "write_reviews",
]
