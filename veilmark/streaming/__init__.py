"""Incremental forms of the consumer and of change deduplication."""

from .canonical import canonical_stream, late_rows, published, settled, waiting, write_canonical
from .consume import consume_stream, dedupe_stream, message_stream

__all__ = [
    "canonical_stream",
    "consume_stream",
    "dedupe_stream",
    "late_rows",
    "message_stream",
    "published",
    "settled",
    "waiting",
    "write_canonical",
]
