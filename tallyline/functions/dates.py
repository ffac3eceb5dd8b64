"""Calendar parts of a transaction timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_date(ts: str = "txn_ts") -> Column:
    return F.to_date(ts)


def month_key(ts: str = "txn_ts") -> Column:
    """The month as text, ``yyyyMM``.

    Year and month are read as numbers: cheaper than a formatter, and a wall-clock time
    takes no detour over the session zone.
    """
    return F.lpad((F.year(ts) * 100 + F.month(ts)).cast("string"), 6, "0")


def year_part(ts: str = "txn_ts") -> Column:
    return F.year(ts)


def month_part(ts: str = "txn_ts") -> Column:
    return F.month(ts)
