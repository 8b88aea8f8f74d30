"""Imports every module of queries, which registers them."""

from dyelake.plans import calls_queries, radmat_queries, scheme_queries, sequence_queries, survey_queries  # noqa: F401
from dyelake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
