"""Rounding used where results are compared between engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded, with negative zero turned into zero."""
    x = F.round(F.col(c) if isinstance(c, str) else c, digits)
    return F.when(x == 0, F.lit(0.0)).otherwise(x)
