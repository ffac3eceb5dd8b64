"""Synthetic tables. Rows are native expressions over an id, see ``functions.draws``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


ROWS_PER_TASK = 5_000_000


def ids(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 1 to ``n`` in a column ``id``; by default a bounded number of them per task."""
    if partitions is None:
        partitions = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    return spark.range(1, n + 1, 1, partitions)
