"""Display values that go with a predicted price."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def amount_text(value: Column, currency: str = "AED") -> Column:
    """'AED 1,234,567': no decimals, thousands separated."""
    return F.concat(F.lit(currency + " "), F.format_number(value, 0))


def price_per_area(price: Column, area: Column) -> Column:
    """price / area, 0 where the area is not positive."""
    return F.when(area > 0, price / area).otherwise(F.lit(0.0))
