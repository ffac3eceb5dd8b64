"""Joins of facts with dimensions.

A dimension is broadcast only after its bytes have been measured. Beyond the limit the
join is left to Catalyst: a shuffle join whose hot keys adaptive execution splits, or a
broadcast after all when the shuffled side proves small at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024

#: Bytes counted for a row and for each of its fields besides variable-length contents.
ROW_OVERHEAD = 16
FIELD_BYTES = 16


def _row_bytes(df: DataFrame) -> Column:
    fixed = F.lit(ROW_OVERHEAD + FIELD_BYTES * len(df.columns)).cast("bigint")
    variable = [
        F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)).cast("bigint")
        for field in df.schema
        if isinstance(field.dataType, T.StringType) or field.dataType.typeName() in _NESTED
    ]
    return reduce(lambda left, right: left + right, variable, fixed)


_NESTED = {"array", "map", "struct", "binary", "variant"}


def measured_bytes(*sides: DataFrame) -> list[int]:
    """Bytes of each side, measured in one job that returns one number per side."""
    sums = [
        side.agg(F.coalesce(F.sum(_row_bytes(side)), F.lit(0)).alias("bytes")).select(
            F.lit(position).alias("position"), "bytes"
        )
        for position, side in enumerate(sides)
    ]
    found = {row.position: row.bytes for row in reduce(DataFrame.unionAll, sums).collect()}
    return [found[position] for position in range(len(sides))]


def broadcast_if_small(
    *sides: DataFrame, limit: int = BROADCAST_LIMIT_BYTES
) -> list[DataFrame]:
    """The sides, those within ``limit`` marked for broadcast."""
    return [
        F.broadcast(side) if size <= limit else side
        for side, size in zip(sides, measured_bytes(*sides), strict=True)
    ]


def join_dimensions(
    facts: DataFrame,
    dimensions: Sequence[tuple[str, DataFrame]],
    how: str = "left",
    strategy: str = "broadcast",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join ``(key, dimension)`` pairs one after another, each by equality on its key.

    ``strategy``: ``broadcast`` (measured), ``merge`` (sort-merge) or ``auto`` (Catalyst).
    """
    keys = [key for key, _ in dimensions]
    sides = [side for _, side in dimensions]
    if strategy == "broadcast":
        sides = broadcast_if_small(*sides, limit=limit)
    elif strategy == "merge":
        sides = [side.hint("merge") for side in sides]
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy: {strategy}")
    for key, side in zip(keys, sides, strict=True):
        facts = facts.join(side, key, how)
    return facts


def fan_out(
    facts: DataFrame, pairs: DataFrame, key: str, strategy: str = "auto"
) -> DataFrame:
    """Inner join with a side that may repeat the key: every match is a row.

    Few keys with very many facts each are what a shuffle join is worst at, so ``auto`` looks
    at the measured size of the pairs as ``broadcast`` does, and leaves the rest to Catalyst.
    """
    if strategy == "auto":
        strategy = "broadcast"
    return join_dimensions(facts, [(key, pairs)], how="inner", strategy=strategy)


def fanned_out_sum(
    facts: DataFrame, pairs: DataFrame, key: str, group: str, measure: str
) -> DataFrame:
    """``sum(measure)`` per ``group`` of the fan-out join, without forming the joined rows.

    Facts shrink to one row per key and pairs to one row per (key, group) with a count, so
    neither a hot key nor a repeated pair multiplies rows.
    """
    per_key = facts.groupBy(key).agg(F.sum(measure).alias("_total"))
    per_pair = pairs.groupBy(key, group).agg(F.count(F.lit(1)).alias("_copies"))
    return (
        per_key.join(per_pair, key)
        .groupBy(group)
        .agg(F.sum(F.col("_total") * F.col("_copies")).alias(measure))
    )
