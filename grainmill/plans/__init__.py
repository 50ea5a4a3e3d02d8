"""Queries over the corpus tables and the SQL they are compared with."""

from grainmill.plans import profile, quality, rules, similar, tokens  # noqa: F401, I001
from grainmill.plans import generated  # noqa: F401  (its checks are queries of the others)
from grainmill.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
