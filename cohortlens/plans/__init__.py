"""Query plans: the registry of named analyses over the driver tables and
their oracle SQL."""

from cohortlens.plans.registry import HEADLINE, oracle_sql, queries

__all__ = ["HEADLINE", "oracle_sql", "queries"]
