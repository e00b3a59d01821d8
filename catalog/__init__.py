"""Registered queries over the driver's tables, each with the SQL it must agree with."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import factors, ingest, models, prepared, terms, topics  # noqa: F401  (register on import)
