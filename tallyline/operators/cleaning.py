"""Row filters, defaults, deduplication and data-quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_valid(enriched: DataFrame) -> DataFrame:
    """Drop unknown products and non-positive quantities or prices (price left NULL)."""
    return enriched.filter(
        F.col("unit_price").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    )


def zero_missing_price(enriched: DataFrame) -> DataFrame:
    """Unit price of unknown products becomes 0."""
    return enriched.withColumn(
        "unit_price",
        F.coalesce("base_price", F.lit(0).cast(enriched.schema["base_price"].dataType)),
    )


def keep_positive(enriched: DataFrame) -> DataFrame:
    """Drop non-positive quantities or prices (missing price already 0)."""
    return enriched.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def fill_unknown(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    return df.fillna(value, subset=list(columns))


def first_copy(
    df: DataFrame, key: str, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per ``key``, the first by ``order`` (by default all other columns).

    The order is total over the columns, so any two rows that tie are equal. Each map task
    keeps one copy per key before the shuffle: a key with a huge number of copies sends
    one row per task, not the copies.
    """
    ranked = Window.partitionBy(key).orderBy(
        *(order or [name for name in df.columns if name != key])
    )
    return (
        df.withColumn("_copy", F.row_number().over(ranked))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: NULL count and row count, from a single pass."""
    counted = df.agg(
        *[
            F.coalesce(F.sum(F.col(name).isNull().cast("bigint")), F.lit(0)).alias(name)
            for name in df.columns
        ],
        F.count(F.lit(1)).alias("_rows"),
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_count"))
            for name in df.columns
        ]
    )
    return counted.select(F.explode(pairs).alias("pair"), "_rows").select(
        "pair.column_name", "pair.null_count", F.col("_rows").alias("row_count")
    )


def banded(column: str, lower_bounds: Mapping[str, int], below: str, missing: str):
    """Label of the highest lower bound a value reaches; labels in ascending order."""
    label = F.when(F.col(column).isNull(), missing)
    for name, bound in sorted(lower_bounds.items(), key=lambda item: -item[1]):
        label = label.when(F.col(column) >= bound, name)
    return label.otherwise(below)
