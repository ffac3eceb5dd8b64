"""Order on a space-filling curve: a condition on any of several columns skips most of a table.

Each column is cut at quantiles, so its ranks are spread evenly whatever its values are, and the bits
of the ranks are interleaved to one number. Rows that are near in all columns are then near in the
table, and every file and row group covers a small range of each of them. Where ranges overlap,
Bloom filters in the files tell whether a value is there at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank: 2 ** BITS - 1 quantiles are taken of it.
BITS = 5

#: Small row groups, so that a file can be skipped in part.
ROW_GROUP_BYTES = 32 * 1024 * 1024

#: Relative accuracy of the quantiles.
ACCURACY = 10_000


def _number(df: DataFrame, name: str) -> Column:
    """The column on a line of numbers."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp").cast("double")
    if isinstance(kind, T.StringType):
        # The first seven bytes of the text, so neighbours in order stay neighbours.
        start = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0")
        return F.conv(start, 16, 10).cast("double")
    raise TypeError(f"{name}: {kind.simpleString()} has no place on a line")


def quantiles(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Distinct quantiles of each column, by one pass of mergeable sketches; what comes back is
    bounded by their number."""
    cuts = [k / 2**bits for k in range(1, 2**bits)]
    sketched = df.agg(
        *[
            F.percentile_approx(_number(df, name), cuts, ACCURACY).alias(name)
            for name in columns
        ]
    ).first()
    return {name: sorted(set(sketched[name] or [])) for name in columns}


def _rank(value: Column, bounds: Sequence[float], low: int = 0) -> Column:
    """How many bounds are at most the value, by halving; a NULL is before all."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(value >= bounds[middle], _rank(value, bounds[middle + 1 :], low + middle + 1)).otherwise(
        _rank(value, bounds[:middle], low)
    )


def curve(
    df: DataFrame, bounds: dict[str, list[float]], bits: int = BITS
) -> Column:
    """The place of a row on the curve."""
    place = F.lit(0).cast("long")
    for position, (name, cuts) in enumerate(bounds.items()):
        rank = _rank(_number(df, name), cuts).cast("long")
        for bit in range(bits):
            moved = F.call_function(
                "shiftleft",
                F.call_function("shiftright", rank, F.lit(bit)).bitwiseAND(F.lit(1)),
                F.lit(bit * len(bounds) + position),
            )
            place = place.bitwiseOR(moved)
    return place


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int,
    *,
    row_key: Sequence[str] = (),
    bits: int = BITS,
    **options: str,
) -> None:
    """Parquet in ``files`` files along the curve, with Bloom filters on ``columns``.

    ``row_key``, by default all columns, orders rows at the same place of the curve, so a place
    that holds a large part of the rows is spread over several files. Parquet leaves the Bloom
    filter out where a dictionary of all values does its work. ``options`` go to the writer.
    """
    placed = df.withColumn("_place", curve(df, quantiles(df, columns, bits), bits))
    tie = F.xxhash64(*(row_key or df.columns))
    writer = (
        placed.repartitionByRange(files, "_place", tie)
        .sortWithinPartitions("_place")
        .drop("_place")
        .write.options(**{"parquet.block.size": str(ROW_GROUP_BYTES)} | options)
    )
    for name in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)
