"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: str | Column, places: int) -> Column:
    """Round half away from zero on the value's shortest decimal form (Spark ``round``)."""
    return F.round(F.col(col) if isinstance(col, str) else col, places)
