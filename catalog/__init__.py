"""Registered queries: each operator over the driver's tables, with the same question in SQL."""

from catalog import cleaning, derived, files, loading, operators, profiles  # noqa: F401
from catalog.base import ORACLE, QUERIES  # noqa: F401
