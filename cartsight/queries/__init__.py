"""Registered queries over the given tables, each with its SQL where SQL can say it."""

from cartsight.queries.base import ORACLES, QUERIES
from cartsight.queries import core, declared, models, summaries, tables  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
