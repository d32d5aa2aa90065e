"""Operators of a training-data pipeline, and their registered queries.

Nothing else in the library imports this subpackage.
"""

from strata.llm import queries  # noqa: F401  (registers the queries)
from strata.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
