"""Totals over all grains of month, region and category at once, and distinct customers of any grain.

A grain is named by ``GRAIN``, a number with one bit for each key, set where the key is added up: a
region that is NULL is a group of its own and never mistaken for a total over regions.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("yyyymm", "region", "category")
GRAIN = "grain"

#: Registers of a distinct-count sketch are 2 ** LOG_REGISTERS; the error is three standard errors.
LOG_REGISTERS = 12
ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)


def all_grains(keys: Sequence[str]) -> list[list[str]]:
    """Every subset of the keys, the finest first."""
    return [list(some) for n in range(len(keys), -1, -1) for some in combinations(keys, n)]


def revenue_cube(
    sales: DataFrame, keys: Sequence[str] = KEYS, grains: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """Revenue, units and rows of every grain: one pass over the sales, one shuffle.

    Each task adds up its own rows of all grains first, so what is shuffled is a row for each
    group and task, not a copy of the sales for each grain.
    """
    sets = [[F.col(name) for name in grain] for grain in (grains or all_grains(keys))]
    return sales.groupingSets(sets, *keys).agg(
        F.grouping_id().cast("int").alias(GRAIN),
        F.sum("total_amount").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("row_count"),
    )


def customer_sketches(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The finest grain with a sketch of its customers: small, mergeable, to be stored."""
    return sales.groupBy(*keys).agg(
        F.hll_sketch_agg("customer_id", LOG_REGISTERS).alias("customers")
    )


def distinct_customers(
    sketches: DataFrame, keys: Sequence[str] = KEYS, grains: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """About how many customers each group of each grain has, from stored sketches alone.

    The sales are not read again: a coarser grain is the union of the sketches below it. Counts are
    within ``ERROR`` of the true ones; small groups are exact.
    """
    sets = [[F.col(name) for name in grain] for grain in (grains or all_grains(keys))]
    union = F.hll_sketch_estimate(F.hll_union_agg("customers"))
    return sketches.groupingSets(sets, *keys).agg(
        F.grouping_id().cast("int").alias(GRAIN), union.alias("estimate")
    )


def distinct_customers_exact(
    sales: DataFrame, keys: Sequence[str] = KEYS, grains: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """The same by counting. Customers are made distinct at the finest grain before the grains
    multiply them."""
    sets = [[F.col(name) for name in grain] for grain in (grains or all_grains(keys))]
    distinct = sales.select(*keys, "customer_id").distinct()
    return distinct.groupingSets(sets, *keys).agg(
        F.grouping_id().cast("int").alias(GRAIN),
        F.countDistinct("customer_id").alias("customer_count"),
    )
