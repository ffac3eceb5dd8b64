"""Declared constraints: every rule that a row breaks, found without dropping the row.

Rules about a row's own values become columns of one projection. Uniqueness and the counts of all rules
come from one aggregate by the row's id, which map tasks reduce before the shuffle. A foreign key is
checked by its distinct values: those that the dimension lacks are few, and the rows that may have one
are told by a Bloom filter of them where they are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.joins import BROADCAST_LIMIT_BYTES, measured_bytes
from tallyline.operators.membership import bloom_words, held_by, words_for
from tallyline.sinks.scratch import fresh_path


@dataclass(frozen=True)
class Check:
    """A condition that every row must meet; a row for which it is NULL breaks it."""

    name: str
    condition: Column


@dataclass(frozen=True)
class ForeignKey:
    """Values of ``column`` must be in ``key`` of the dimension; NULL refers to nothing and is fine."""

    name: str
    column: str
    dimension: DataFrame
    key: str


@dataclass(frozen=True)
class Unique:
    """No two rows may have the same id."""

    name: str


Rule = Check | ForeignKey | Unique


def within(name: str, column: str, low: object = None, high: object = None) -> Check:
    """A value between two bounds, either of which may be left open."""
    bounds = []
    if low is not None:
        bounds.append(F.col(column) >= low)
    if high is not None:
        bounds.append(F.col(column) <= high)
    return Check(name, reduce(Column.__and__, bounds, F.col(column).isNotNull()))


def one_of(name: str, column: str, values: Sequence[object]) -> Check:
    return Check(name, F.col(column).isin(list(values)))


def missing_keys(df: DataFrame, rule: ForeignKey) -> DataFrame:
    """The distinct values of the column that the dimension lacks, as a written table."""
    used = df.select(F.col(rule.column).alias("bad")).where(F.col("bad").isNotNull()).distinct()
    known = rule.dimension.select(F.col(rule.key).alias("bad"))
    lacking = used.join(known, "bad", "left_anti")
    path = fresh_path(df.sparkSession, "missing_keys")
    lacking.write.parquet(path)
    return df.sparkSession.read.schema(lacking.schema).parquet(path)


def _broken_key(df: DataFrame, rule: ForeignKey, flag: str, limit: int) -> DataFrame:
    """``df`` with ``flag``: whether its foreign key leads nowhere."""
    bad = missing_keys(df, rule)
    marked = bad.withColumn(flag, F.lit(True))
    here = F.col(rule.column) == F.col("bad")

    def exact(rows: DataFrame, side: DataFrame) -> DataFrame:
        joined = rows.join(side, here, "left").drop("bad")
        return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))

    (size,) = measured_bytes(bad)
    if size <= limit:
        return exact(df, F.broadcast(marked))
    words = words_for(bad.count())
    may_be = held_by(df, bloom_words(bad, "bad", words), rule.column, words, "_may_be")
    sure = may_be.where(~F.col("_may_be")).drop("_may_be").withColumn(flag, F.lit(False))
    return sure.unionByName(exact(may_be.where("_may_be").drop("_may_be"), marked))


def tagged(df: DataFrame, rules: Sequence[Rule], limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with ``broken``, the names of the checks and foreign keys that the row breaks."""
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names):
        raise ValueError(f"two rules have one name: {sorted(names)}")
    columns, broken = df.columns, []
    for position, rule in enumerate(rules):
        if isinstance(rule, Check):
            is_broken = ~F.coalesce(rule.condition, F.lit(False))
        elif isinstance(rule, ForeignKey):
            flag = f"_broken_{position}"
            df = _broken_key(df, rule, flag, limit)
            is_broken = F.col(flag)
        else:
            continue
        broken.append(F.when(is_broken, rule.name))
    names_broken = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.select(*columns, names_broken.alias("broken"))


def violations(
    df: DataFrame, row_id: str, rules: Sequence[Rule], limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """One row for each id and rule it breaks, with the number of its rows that do."""
    named = [rule.name for rule in rules if not isinstance(rule, Unique)]
    unique = [rule.name for rule in rules if isinstance(rule, Unique)]
    checked = tagged(df, rules, limit)
    counts = checked.groupBy(row_id).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(F.array_contains("broken", name)).alias(f"_rule_{position}")
            for position, name in enumerate(named)
        ],
    )
    found = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_rule_{position}").alias("row_count"))
        for position, name in enumerate(named)
    ] + [
        F.struct(
            F.lit(name).alias("rule"),
            F.when(F.col("_rows") > 1, F.col("_rows")).otherwise(F.lit(0)).alias("row_count"),
        )
        for name in unique
    ]
    return (
        counts.select(row_id, F.explode(F.array(*found)).alias("found"))
        .select(row_id, "found.rule", "found.row_count")
        .where(F.col("row_count") > 0)
    )


def quarantined(
    df: DataFrame, row_id: str, rules: Sequence[Rule], limit: int = BROADCAST_LIMIT_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all rules, and the others with ``broken``. No row is in both or neither."""
    checked = tagged(df, rules, limit)
    unique = [rule.name for rule in rules if isinstance(rule, Unique)]
    if unique:
        repeated = df.groupBy(row_id).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        again = repeated.select(F.col(row_id).alias("_id"), F.lit(True).alias("_again"))
        joined = checked.join(again, F.col(row_id).eqNullSafe(F.col("_id")), "left")
        more = F.when(F.col("_again"), F.array(*map(F.lit, unique))).otherwise(
            F.array().cast("array<string>")
        )
        checked = joined.select(*df.columns, F.concat("broken", more).alias("broken"))
    return (
        checked.where(F.size("broken") == 0).drop("broken"),
        checked.where(F.size("broken") > 0),
    )
