"""Windows over small, already aggregated series (one row per month or category)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def trailing_mean(measure: str, order: str, rows: int) -> Column:
    """Mean of this row and the ``rows - 1`` rows before it."""
    return F.avg(measure).over(Window.orderBy(order).rowsBetween(1 - rows, 0))


def growth_percent(measure: str, order: str) -> Column:
    """Change against the preceding row in percent; NULL for the first row or after a 0."""
    before = F.lag(measure).over(Window.orderBy(order))
    change = (F.col(measure) - before).cast("double")
    return F.round(F.try_divide(change, before.cast("double")) * 100, 4)


def share_of_total(measure: str) -> Column:
    """Fraction of the column's total, rounded to 6 places; NULL when the total is 0."""
    total = F.sum(measure).over(Window.partitionBy())
    return F.round(F.try_divide(F.col(measure).cast("double"), total.cast("double")), 6)
