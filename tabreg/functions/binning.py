"""Equal-width histogram bins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of ``value`` in [low, high]; the last bin is closed on the right.

    When all values are equal the range is widened by one half on both sides.
    """
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    raw = F.floor((value - start) * F.lit(float(bins)) / width).cast("int")
    return F.least(raw, F.lit(bins - 1))
