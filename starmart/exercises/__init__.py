"""The registered queries: every operator run over the whole test tables, with the SQL that checks it."""

from starmart.exercises import dims, facts, files, marts, scalars, tables  # noqa: F401  (registers)
from starmart.exercises.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
