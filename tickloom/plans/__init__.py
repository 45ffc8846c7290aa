"""Registered queries over the test tables, and their SQL counterparts."""

from tickloom.plans.queries import QUERIES
from tickloom.plans.sql import SQL

__all__ = ["QUERIES", "SQL"]
