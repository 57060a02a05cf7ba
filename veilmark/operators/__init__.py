"""DataFrame-level operators."""

from . import catalog, detect, joins, latest, mask, nested, report

__all__ = ["catalog", "detect", "joins", "latest", "mask", "nested", "report"]
