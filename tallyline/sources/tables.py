"""Parquet sources and the three-table star."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingTables(RuntimeError):
    """One or more required tables are not there."""

    def __init__(self, paths: Iterable[str]):
        self.paths = sorted(paths)
        super().__init__("required tables not found: " + ", ".join(self.paths))


class RepeatedKeys(RuntimeError):
    """A dimension holds a key more than once, or a NULL key."""


@dataclass(frozen=True)
class Star:
    """Transactions with their two dimensions. Any frames will do, also in-session ones."""

    txns: DataFrame
    customers: DataFrame
    products: DataFrame


#: Folder of each table under the base of a star.
STAR_TABLES = {"txns": "txns", "customers": "dim_customers", "products": "dim_products"}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None when nothing is at ``path`` on whichever filesystem it names."""
    return if_present(lambda: read_table(spark, path, schema))


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None when its path is not there; other errors stay errors."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_all(paths: Iterable[str], read: Callable[[str], DataFrame]) -> list[DataFrame]:
    """The table at every path; all missing ones are named in one error."""
    found = {path: if_present(lambda path=path: read(path)) for path in paths}
    absent = [path for path, frame in found.items() if frame is None]
    if absent:
        raise MissingTables(absent)
    return list(found.values())


def star_paths(base: str) -> dict[str, str]:
    return {name: f"{base.rstrip('/')}/{folder}" for name, folder in STAR_TABLES.items()}


def read_star(spark: SparkSession, base: str) -> Star:
    """The Parquet star under ``base``."""
    paths = star_paths(base)
    frames = read_all(paths.values(), lambda path: read_table(spark, path))
    return Star(**dict(zip(paths, frames, strict=True)))


def require_unique_key(dimension: DataFrame, key: str) -> None:
    """Fail when a dimension would multiply facts: one distributed count, one row back."""
    counts = (
        dimension.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum((F.col("copies") > 1).cast("bigint")), F.lit(0)).alias("repeated"),
            F.coalesce(F.sum(F.col(key).isNull().cast("bigint")), F.lit(0)).alias("empty"),
        )
        .first()
    )
    if counts.repeated or counts.empty:
        raise RepeatedKeys(f"{key}: {counts.repeated} repeated keys, {counts.empty} NULL keys")
