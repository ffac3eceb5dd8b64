"""Physical layout: how rows are spread, kept and inspected."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows that a task of a set number of tasks is meant to hold.
ROWS_PER_TASK = 1_000_000


def tasks_for(rows: int, least: int = 1, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many tasks so many rows need."""
    return max(least, -(-rows // rows_per_task))


def spread_by_keys(
    df: DataFrame, n: int | None, *keys: str, spread: int = 1, row_key: Sequence[str] = ()
) -> DataFrame:
    """Hash the rows into ``n`` partitions by ``keys``; with None, adaptive execution
    chooses the number.

    With ``spread`` above 1 every key goes to up to that many partitions, so a key that
    holds a large part of the rows does not end in one task. The salt is a hash of
    ``row_key``, columns that tell rows apart, or of the whole row: a retried task sends its
    rows to the same places. Rows that are equal in those columns stay together.
    """
    count = [] if n is None else [n]
    if spread <= 1:
        return df.repartition(*count, *keys)
    salt = F.pmod(F.xxhash64(*(row_key or df.columns)), F.lit(spread))
    return df.withColumn("_salt", salt).repartition(*count, *keys, "_salt").drop("_salt")


def group_for_write(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows with equal keys together before a partitioned write.

    Adaptive execution merges small groups and splits large ones to its advisory size.
    """
    return df.hint("rebalance", *[F.col(key) for key in keys])


@contextmanager
def persisted(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a frame for several uses and release it whatever happens.

    Lost blocks are computed again from the sources.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def balance(df: DataFrame, n: int, factor: float = 4.0) -> DataFrame:
    """One row: how many rows there are, whether they lie in at most ``n`` partitions, and
    whether none of those holds more than ``factor`` times the mean over ``n``."""
    total = F.coalesce(F.sum("row_count"), F.lit(0))
    return partition_profile(df).agg(
        total.alias("row_count"),
        (F.count(F.lit(1)) <= n).alias("within_count"),
        (F.coalesce(F.max("row_count"), F.lit(0)) * n <= total * factor).alias("is_balanced"),
    )


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows held by each partition of a frame."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
