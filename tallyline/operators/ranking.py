"""Top rows, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_overall(df: DataFrame, measure: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows; ``tie_break`` makes the cut the same each time."""
    return df.orderBy(F.desc(measure), *tie_break).limit(n)


def top_per_group(
    df: DataFrame,
    group: str,
    measure: str,
    n: int,
    method: str = "dense_rank",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows ranked within ``group`` by descending ``measure``, ranks 1 to ``n``.

    ``dense_rank`` and ``rank`` keep all ties, which may be a large part of a group, so no
    window ever holds them together. First every input partition drops the rows below its
    own ``n`` best values. The best values of the group are then ranked, one row per value,
    and joined back to the rows that were left.

    ``row_number`` keeps exactly ``n`` rows; ``tie_break`` must then make the order total.
    """
    if method == "row_number":
        order = Window.partitionBy(group).orderBy(F.desc(measure), *tie_break)
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    if method not in ("dense_rank", "rank"):
        raise ValueError(f"unknown ranking method: {method}")

    within_part = Window.partitionBy(group, "_part").orderBy(F.desc(measure))
    candidates = (
        df.withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.dense_rank().over(within_part))
        .filter(F.col("_local") <= n)
        .drop("_part", "_local")
    )

    within_group = Window.partitionBy(group).orderBy(F.desc(measure))
    values = (
        candidates.groupBy(group, measure)
        .agg(F.count(F.lit(1)).alias("_ties"))
        .withColumn("_dense", F.dense_rank().over(within_group))
        .filter(F.col("_dense") <= n)
    )
    if method == "dense_rank":
        ranked = values.withColumn("rank", F.col("_dense"))
    else:
        above = within_group.rowsBetween(Window.unboundedPreceding, -1)
        ranked = values.withColumn(
            "rank", (F.coalesce(F.sum("_ties").over(above), F.lit(0)) + 1).cast("bigint")
        ).filter(F.col("rank") <= n)
    ranked = ranked.select(
        F.col(group).alias("_group"), F.col(measure).alias("_value"), F.col("rank").cast("int")
    )
    return candidates.join(
        ranked,
        F.col(group).eqNullSafe(F.col("_group")) & F.col(measure).eqNullSafe(F.col("_value")),
    ).drop("_group", "_value")
