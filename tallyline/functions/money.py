"""Exact money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.schemas import AMOUNT, PRICE


def price(column: str | Column) -> Column:
    """A price as ``decimal(12,2)``."""
    return (F.col(column) if isinstance(column, str) else column).cast(PRICE)


def line_amount(unit_price: str = "unit_price", quantity: str = "quantity") -> Column:
    """Unit price times quantity as ``decimal(18,2)``: fits a long, sums stay exact."""
    return (price(unit_price) * F.col(quantity)).cast(AMOUNT)


def doubles(df, *columns: str):
    """Show money columns as doubles, for the last projection of a report."""
    return df.withColumns({name: F.col(name).cast("double") for name in columns})
