"""Column-level building blocks: every function maps columns to a column."""

from . import clean, crypto, jsonx

__all__ = ["clean", "crypto", "jsonx"]
