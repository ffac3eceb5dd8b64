"""Tables stored by buckets of a key: joins and groupings on the key need no shuffle.

Both sides are dealt into the same number of buckets once, when they are written, and each bucket is
one sorted file. Whoever joins them afterwards reads bucket beside bucket.

A bucket is one task at every later join, and unlike a shuffle partition it cannot be split there.
So the balance is measured before anything is written: a table with a hot key is stored without
buckets, and its joins stay shuffle joins, which adaptive execution splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sinks.scratch import fresh_path

#: A bucket may hold so many times the mean before the table counts as skewed.
MOST_TIMES_MEAN = 4.0


@dataclass(frozen=True)
class Stored:
    """A stored table: ``buckets`` is 0 where it has none."""

    path: str
    key: str
    buckets: int
    frame: DataFrame


def is_balanced(df: DataFrame, key: str, buckets: int, factor: float = MOST_TIMES_MEAN) -> bool:
    """Whether no bucket would hold more than ``factor`` times the mean of all. Rows are counted
    where they are; one number for each bucket is shuffled, and one row comes back."""
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    found = sizes.agg(F.max("rows").alias("most"), F.sum("rows").alias("all")).first()
    return found.most is None or found.most * buckets <= factor * max(found["all"], buckets)


def _written(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """One sorted file for each bucket. The catalog entry is needed to tell Spark of the buckets;
    the frame keeps that, so the entry goes at once and the files stay."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return frame


def store_by_key(
    spark: SparkSession,
    tables: Sequence[tuple[str, DataFrame, str]],
    buckets: int,
    factor: float = MOST_TIMES_MEAN,
) -> list[Stored]:
    """Store (name, frame, key) tables that are joined on their keys, all in as many buckets.

    If one of them has a hot key none gets buckets: a shuffle on one side alone would bring the
    hot key into one task as well.
    """
    even = all(is_balanced(df, key, buckets, factor) for _, df, key in tables)
    stored = []
    for name, df, key in tables:
        path = fresh_path(spark, name)
        if even:
            frame = _written(df, path, key, buckets)
        else:
            df.write.parquet(path)
            frame = spark.read.schema(df.schema).parquet(path)
        stored.append(Stored(path, key, buckets if even else 0, frame))
    return stored
