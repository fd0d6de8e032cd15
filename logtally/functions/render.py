"""Text drawn from numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bar widths of the level and the hour section, and what bars are made of.
LEVEL_BAR = 30
HOUR_BAR = 40
FULL, EMPTY = "█", "░"


def bar(pct: Column, width: int) -> Column:
    """A bar of ``width`` characters, filled to ``pct`` percent, halves rounded up."""
    filled = F.floor(pct / F.lit(100.0) * F.lit(width) + F.lit(0.5)).cast("int")
    return F.concat(F.repeat(F.lit(FULL), filled), F.repeat(F.lit(EMPTY), F.lit(width) - filled))
