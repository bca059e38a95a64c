"""Small numeric helpers for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0 turns a negative zero into zero."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits) + F.lit(0.0)
