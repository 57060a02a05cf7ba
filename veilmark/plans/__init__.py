"""Data products composed from the operators."""

from . import cdc, documents, events, loans, refine, vault, views

__all__ = ["cdc", "documents", "events", "loans", "refine", "vault", "views"]
