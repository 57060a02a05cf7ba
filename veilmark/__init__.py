"""Privacy-compliance data engine on PySpark."""

from . import sources as io
from .functions import clean, crypto, jsonx
from .operators import catalog, detect, joins, latest, mask, nested, report
from .plans import events, refine, vault, views
from .session import configure, local_session

__all__ = [
    "catalog",
    "clean",
    "configure",
    "crypto",
    "detect",
    "events",
    "io",
    "joins",
    "jsonx",
    "latest",
    "local_session",
    "mask",
    "nested",
    "refine",
    "report",
    "vault",
    "views",
]
