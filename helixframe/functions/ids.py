"""Identifiers as they are compared across tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spelled(c: Column) -> Column:
    """Trimmed and in upper case; null stays null."""
    return F.upper(F.trim(c))


def names_something(c: Column) -> Column:
    """False for null, empty and `.` ids (`c` as given by `spelled`)."""
    return c.isNotNull() & ~c.isin("", ".")
