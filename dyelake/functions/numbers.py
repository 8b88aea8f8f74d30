"""Scalar expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: Column | str, b: Column | str, default: float = 0.0) -> Column:
    """a / b, or ``default`` where b is 0, null or NaN."""
    a, b = _col(a), _col(b)
    fine = (b != 0) & ~F.isnan(b.cast("double"))
    return F.when(fine, a / b).otherwise(F.lit(default))


def nan_to_num(x: Column | str, default: float = 0.0) -> Column:
    """x, or ``default`` where it is null or NaN."""
    return F.coalesce(F.nanvl(_col(x), F.lit(default)), F.lit(default))


def gaussian(x: Column | str, mean: float, sigma: float) -> Column:
    """exp(-((x - mean) / sigma)^2 / 2)."""
    z = (_col(x) - mean) / sigma
    return F.exp(-z * z / 2)
