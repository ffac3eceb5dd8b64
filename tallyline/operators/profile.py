"""A profile of every column in one pass: NULLs, quantiles, distinct values, frequent values.

All of it is made of mergeable sketches. Tasks sketch what they read, their sketches are merged in
``PARTS`` groups, and only the groups' sketches meet in one task, whatever the number of tasks was. The
same sketches can be stored by day and merged later. With n the values of a column that are not NULL:

* a quantile has a rank within ``RANK_ERROR * n`` of the one asked for; the ends are exact;
* the number of distinct values is within ``DISTINCT_ERROR`` of the true one (three standard errors);
* a value that more than ``n / TRACKED`` rows have is among the frequent candidates, and its count
  is at most ``3.5 * n / TRACKED`` off.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
KLL_SIZE = 1_024
RANK_ERROR = 0.01
LOG_REGISTERS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)
FREQUENT = 5
TRACKED = 2_048

#: Groups in which the tasks' sketches are merged before they meet.
PARTS = 200

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _number(name: str, kind: T.DataType) -> tuple[str, Column] | None:
    """Which sketch of numbers a column has, and the number of a value; None where it has no order
    of numbers or time."""
    column = F.col(name)
    if isinstance(kind, _WHOLE):
        return "bigint", column.cast("long")
    if isinstance(kind, T.DateType):
        return "bigint", F.unix_date(column).cast("long")
    if isinstance(kind, _TIMES):
        return "bigint", F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return "double", column.cast("double")
    return None


def _as_text(kind: T.DataType) -> Callable[[Column], Column]:
    """What turns a number of the sketch back into the text of a value."""

    def text(value: Column) -> Column:
        if isinstance(kind, T.DateType):
            value = F.date_from_unix_date(value.cast("int"))
        elif isinstance(kind, _TIMES):
            value = F.timestamp_micros(value)
        return value.cast("string")

    return text


def sketches(df: DataFrame, columns: Sequence[str], parts: int = PARTS) -> DataFrame:
    """``parts`` rows of sketches, or a few more; those of several tables with the same columns may
    be put together and merged by ``merged``. An empty table has a sketch of nothing."""
    given = df.select(*columns, F.lit(1).cast("long").alias("_row"))
    nothing = df.sparkSession.range(1).select(
        *[F.lit(None).cast(df.schema[name].dataType).alias(name) for name in columns],
        F.lit(0).cast("long").alias("_row"),
    )
    # Two sketches take the text of a value, which is made once.
    mark = "_" * (1 + max(map(len, columns), default=0))
    given = given.unionByName(nothing).withColumns(
        {f"{mark}{position}": F.col(name).cast("string") for position, name in enumerate(columns)}
    )
    state = [F.sum("_row").alias("rows")]
    for position, name in enumerate(columns):
        text = F.col(f"{mark}{position}")
        state += [
            F.count(F.col(name)).alias(f"n{position}"),
            F.hll_sketch_agg(text, LOG_REGISTERS).alias(f"d{position}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"f{position}"),
        ]
        number = _number(name, df.schema[name].dataType)
        if number:
            sketch = F.call_function(f"kll_sketch_agg_{number[0]}", number[1], F.lit(KLL_SIZE))
            state.append(sketch.alias(f"q{position}"))
    part = F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part")
    return given.groupBy(part).agg(*state)


def merged(states: DataFrame, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """column_name, row_count, null_count, distinct_count, quantiles (as text, of columns that have
    an order of numbers or time) and frequent (value as text, count)."""
    whole = [F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")]
    rows = []
    for position, name in enumerate(columns):
        kind = schema[name].dataType
        whole += [
            F.coalesce(F.sum(f"n{position}"), F.lit(0)).alias(f"n{position}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"d{position}")).alias(f"d{position}"),
            F.call_function("approx_top_k_combine", F.col(f"f{position}"), F.lit(TRACKED)).alias(
                f"f{position}"
            ),
        ]
        quantiles = F.lit(None).cast("array<string>")
        number = _number(name, kind)
        if number:
            whole.append(
                F.call_function(f"kll_merge_agg_{number[0]}", F.col(f"q{position}")).alias(f"q{position}")
            )
            asked = F.call_function(
                f"kll_sketch_get_quantile_{number[0]}",
                F.col(f"q{position}"),
                F.array(*map(F.lit, QUANTILES)),
            )
            texts = F.transform(asked, _as_text(kind))
            quantiles = F.when(F.col(f"n{position}") > 0, texts)
        top = F.call_function("approx_top_k_estimate", F.col(f"f{position}"), F.lit(FREQUENT))
        known = F.filter(top, lambda pair: pair["item"].isNotNull())
        frequent = F.transform(
            known, lambda pair: F.struct(pair["item"].alias("value"), pair["count"].alias("count"))
        )
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("row_count"),
                (F.col("row_count") - F.col(f"n{position}")).alias("null_count"),
                F.coalesce(F.col(f"d{position}"), F.lit(0)).alias("distinct_count"),
                quantiles.alias("quantiles"),
                F.when(F.col(f"n{position}") > 0, frequent).alias("frequent"),
            )
        )
    return states.agg(*whole).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, parts: int = PARTS
) -> DataFrame:
    """The profile of the columns, by default of all."""
    names = list(columns or df.columns)
    return merged(sketches(df, names, parts), df.schema, names)
