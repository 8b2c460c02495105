"""Queries over the given tables, one or more per operator, with equivalent SQL to check them."""

from landrecon.catalogue import basics, domain, relations  # noqa: F401  (these register their queries)
from landrecon.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
