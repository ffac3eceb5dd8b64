"""CSV ingest: read as text, then cast column by column without failing the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schemas import CUSTOMERS, PRODUCTS, TRANSACTIONS
from tallyline.sources.tables import Star, read_all, star_paths

CORRUPT = "_corrupt_record"

#: Stands for an unquoted empty field while parsing, so that a quoted one stays empty text.
ABSENT = "\u0001absent"


def read_text_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False
) -> DataFrame:
    """All columns as text. A line with the wrong number of fields lands in ``_corrupt_record``.

    ``multi_line`` allows line breaks inside quoted fields; each file is then one task.
    """
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in columns]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        .option("nullValue", ABSENT)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .csv(path)
    )


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema`` with ``try_cast``. A value that will not cast becomes NULL and,
    like a broken line, sets ``is_bad``."""
    failed = [
        F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()
        for field in schema
    ]
    if CORRUPT in text.columns:
        failed.append(F.col(CORRUPT).isNotNull())
    is_bad = reduce(lambda left, right: left | right, failed)
    return text.select(
        *[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema],
        is_bad.alias("is_bad"),
    )


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    return typed(read_text_csv(spark, path, schema.fieldNames(), multi_line), schema)


STAR_SCHEMAS = {"txns": TRANSACTIONS, "customers": CUSTOMERS, "products": PRODUCTS}


STAR_KEYS = {"txns": "txn_id", "customers": "customer_id", "products": "product_id"}


def _star_lines(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The typed lines of each table with ``is_bad`` and ``has_key``."""
    paths = star_paths(base)
    name_of = {path: name for name, path in paths.items()}

    def lines(path: str) -> DataFrame:
        name = name_of[path]
        typed_lines = read_typed_csv(spark, path, STAR_SCHEMAS[name])
        return typed_lines.withColumn("has_key", F.col(STAR_KEYS[name]).isNotNull())

    return dict(zip(paths, read_all(paths.values(), lines), strict=True))


def read_star_csv(spark: SparkSession, base: str) -> Star:
    """The star from CSV folders. Values that will not cast are NULL, for cleaning to judge;
    a line without its key cannot be told from others and is left to ``rejected_lines``."""
    return Star(
        **{
            name: lines.where("has_key").drop("is_bad", "has_key")
            for name, lines in _star_lines(spark, base).items()
        }
    )


def rejected_lines(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Of each table the lines that are broken, have a value that will not cast (``is_bad``),
    or lack their key (not ``has_key``): nothing that is dropped or blanked goes uncounted."""
    return {
        name: lines.where("is_bad or not has_key")
        for name, lines in _star_lines(spark, base).items()
    }


def inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Schema inference, for looking at an unknown file: it costs a second pass."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
