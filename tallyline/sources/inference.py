"""Types of a CSV file by looking at all of its values once.

Every column climbs a lattice: int, bigint, double for numbers, date, timestamp for times, boolean beside
them, string at the top, which everything fits. One aggregate counts for each column and type the values
that would not fit. A type is taken if the fewest values misfit it, the narrowest of several, and only if
they are at most a given part; what misfits then becomes NULL and sets ``is_bad`` when the file is read.
A schema that looks at part of a file may be wrong about the rest; this one cannot be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources.delimited import CORRUPT, read_text_csv

#: How a value of each type is written. Text beside the pattern does not fit.
WHOLE = r"^[+-]?[0-9]{1,18}$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
BOOLEAN = r"^(true|false|TRUE|FALSE|True|False)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"

#: The lattice from narrow to wide: type, pattern.
LATTICE: tuple[tuple[T.DataType, str], ...] = (
    (T.BooleanType(), BOOLEAN),
    (T.IntegerType(), WHOLE),
    (T.LongType(), WHOLE),
    (T.DoubleType(), DECIMAL),
    (T.DateType(), DAY),
    (T.TimestampNTZType(), TIME),
)

#: The most part of a column's values that may misfit its type.
TOLERANCE = 0.0


def _fits(name: str, kind: T.DataType, pattern: str) -> Column:
    return F.col(name).rlike(pattern) & F.col(name).try_cast(kind).isNotNull()


def type_counts(text: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value_count (not NULL) and misfits, an array in the order of the lattice: one
    row for each column, from one pass and one row for each task."""
    counted = text.agg(
        *[F.count(F.col(name)).alias(f"n{k}") for k, name in enumerate(columns)],
        *[
            F.count_if(_fits(name, kind, pattern)).alias(f"n{k}_{t}")
            for k, name in enumerate(columns)
            for t, (kind, pattern) in enumerate(LATTICE)
        ],
    )
    rows = [
        F.struct(
            F.lit(k).alias("place"),
            F.lit(name).alias("column_name"),
            F.col(f"n{k}").alias("value_count"),
            F.array(
                *[F.col(f"n{k}") - F.col(f"n{k}_{t}") for t in range(len(LATTICE))]
            ).alias("misfits"),
        )
        for k, name in enumerate(columns)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def inferred_types(
    text: DataFrame, columns: Sequence[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """place, column_name, type, value_count, misfits: the type of each column and how many values
    do not fit it. A column without any value is text."""
    names = F.array(*[F.lit(kind.simpleString()) for kind, _ in LATTICE])
    fewest = F.array_min("misfits")
    fits = (F.col("value_count") > 0) & (fewest <= F.col("value_count") * F.lit(tolerance))
    return type_counts(text, columns).select(
        "place",
        "column_name",
        F.when(fits, F.element_at(names, F.array_position("misfits", fewest).cast("int")))
        .otherwise("string")
        .alias("type"),
        "value_count",
        F.when(fits, fewest).otherwise(F.lit(0)).cast("long").alias("misfits"),
    )


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The names in the header of the first file."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def infer_csv(
    spark: SparkSession, path: str, tolerance: float = TOLERANCE, multi_line: bool = False
) -> tuple[T.StructType, DataFrame]:
    """The schema of a CSV file or folder and the report it comes from. The report has one row for
    each column, which is what the driver sees; broken lines are left to ``is_bad``."""
    columns = csv_columns(spark, path)
    text = read_text_csv(spark, path, columns, multi_line).where(F.col(CORRUPT).isNull())
    report = inferred_types(text, columns, tolerance)
    found = report.orderBy("place").collect()
    schema = T.StructType.fromDDL(
        ", ".join(f"`{row.column_name.replace('`', '``')}` {row.type}" for row in found)
    )
    return schema, report
