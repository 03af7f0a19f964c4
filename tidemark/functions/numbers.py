"""Rounding and velocity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def snap(value: Column, places: int) -> Column:
    """Round half up after removing float noise, so the order of a sum cannot flip a tie."""
    return F.round(F.round(value, 8), places)


def velocity(n5m: Column, n1h: Column, mode: str = "shared") -> Column:
    """Transactions per minute.

    ``shared``: n over min(5, max(n, 1)), the definition both paths share.
    ``hourly``: the hourly count over sixty. ``per_minute``: the five-minute count over five.
    """
    if mode == "shared":
        minutes = F.least(F.lit(5.0), F.greatest(n5m.cast("double"), F.lit(1.0)))
        rate = n5m / minutes
    elif mode == "hourly":
        rate = n1h / F.lit(60.0)
    elif mode == "per_minute":
        rate = n5m / F.lit(5.0)
    else:
        raise ValueError(f"unknown velocity mode: {mode}")
    return F.round(rate, 4)
