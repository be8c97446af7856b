"""Registered queries and their SQL."""

from changeledger.plans import capture, feeds, ledger, replay  # noqa: F401
from changeledger.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
