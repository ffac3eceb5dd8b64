"""Repeatable pseudo-random draws.

Every row takes its values from one SHA-256 digest of (seed, table, id). The result
depends on the id alone, so it is the same for any number of partitions, survives task
retries, and can be recomputed by another SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, table: str, row_id: str | Column) -> Column:
    """64 hex digits for a row."""
    source = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(table), source.cast("string")), 256)


def number(digest_column: str, start: int, digits: int) -> Column:
    """``digits`` hex digits of a digest from ``start`` (1-based) as a bigint."""
    if not 1 <= digits <= 15:
        raise ValueError("a draw takes 1 to 15 hex digits")
    return F.conv(F.substring(digest_column, start, digits), 16, 10).cast("bigint")


def below(digest_column: str, start: int, digits: int, bound: int) -> Column:
    """A draw from 0 to ``bound - 1``."""
    return number(digest_column, start, digits) % F.lit(bound).cast("bigint")


def pick(digest_column: str, start: int, digits: int, values: Sequence[str]) -> Column:
    """One of ``values``."""
    position = below(digest_column, start, digits, len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(value) for value in values]), position)


def key_text(seed: int, table: str, row_id: str | Column) -> Column:
    """A key in 8-4-4-4-12 form, the same for the same id wherever it is computed."""
    source = F.col(row_id) if isinstance(row_id, str) else row_id
    hexed = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(table), source.cast("string")))
    return F.regexp_replace(hexed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
