"""Table writers with a dry-run switch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.dates import month_part, year_part
from tallyline.operators.layout import group_for_write


class FormatUnavailable(RuntimeError):
    """The session has no data source of that name."""


@dataclass(frozen=True)
class Written:
    """What was, or in a dry run would have been, written."""

    path: str
    fmt: str
    partition_by: tuple[str, ...]
    done: bool


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    grouped: bool = True,
    files: int | None = None,
    dry_run: bool = True,
) -> Written:
    """Replace the table at ``path``.

    ``partition_by`` writes one folder per value; rows are grouped first, so a folder gets
    few files, and a folder with very many rows gets several writers. ``grouped=False``
    saves that shuffle where a task has rows for few folders. ``files`` sets the file count
    instead. Nothing is written unless ``dry_run`` is switched off.
    """
    plan = Written(path, fmt, tuple(partition_by), done=not dry_run)
    if dry_run:
        return plan
    if files:
        df = df.repartition(files)
    elif partition_by and grouped:
        df = group_for_write(df, *partition_by)
    df = _marked(df, partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(path)
    except (PySparkException, Py4JJavaError) as error:
        if "DATA_SOURCE_NOT_FOUND" in str(error):
            raise FormatUnavailable(
                f"no data source '{fmt}' in this session; add its package or use parquet"
            ) from error
        raise
    return plan


#: Stands for an empty text in a folder's name, where Spark would store it as NULL.
EMPTY = "__empty__"


def _texts(schema: T.StructType, names: Sequence[str]) -> list[str]:
    return [name for name in names if isinstance(schema[name].dataType, T.StringType)]


def _marked(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {
            name: F.when(F.col(name) == "", EMPTY).otherwise(F.col(name))
            for name in _texts(df.schema, partition_by)
        }
    )


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """A table that ``write_table`` has partitioned, empty texts as they were. Conditions on
    the partition columns still choose the folders."""
    reader = spark.read.format(fmt)
    stored = (reader.schema(schema) if fmt == "parquet" else reader).load(path)
    return stored.withColumns(
        {
            name: F.when(F.col(name) == EMPTY, "").otherwise(F.col(name))
            for name in _texts(schema, partition_by)
        }
    )


def write_by_month(
    df: DataFrame, path: str, ts: str = "txn_ts", *, grouped: bool = True, dry_run: bool = True
) -> Written:
    """Parquet in ``year=/month=`` folders taken from a timestamp."""
    dated = df.withColumns({"year": year_part(ts), "month": month_part(ts)})
    return write_table(
        dated, path, partition_by=("year", "month"), grouped=grouped, dry_run=dry_run
    )


def write_csv(df: DataFrame, path: str, *, dry_run: bool = True) -> Written:
    """CSV with a header; text keeps its spaces, quotes are doubled."""
    if not dry_run:
        (
            df.select([F.col(name).cast("string") for name in df.columns])
            .write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    return Written(path, "csv", (), done=not dry_run)
