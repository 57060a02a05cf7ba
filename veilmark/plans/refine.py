"""Raw to parsed layer: change events, versioned documents, loan records."""

from . import cdc, documents, loans

__all__ = ["cdc", "documents", "loans"]
