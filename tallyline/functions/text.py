"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_name(column: str | Column) -> Column:
    """Trim, squeeze inner white space, capitalise every word."""
    source = F.col(column) if isinstance(column, str) else column
    return F.initcap(F.trim(F.regexp_replace(source, r"\s+", " ")))
