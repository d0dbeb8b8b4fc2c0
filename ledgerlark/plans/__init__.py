"""Named queries over the given tables."""

from ledgerlark.plans import evaluation, explaining, facts, gaps, learning, monitoring, operations, portfolio, quality, steps, testing, transforms  # noqa: F401
from ledgerlark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
