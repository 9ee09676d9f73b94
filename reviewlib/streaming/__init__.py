"""The row-local jobs as incremental file streams."""

from reviewlib.streaming.jobs import label_stream, parse_stream, preprocess_stream

__all__ = ["label_stream", "parse_stream", "preprocess_stream"]
