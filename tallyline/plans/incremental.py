"""Late data: a new batch goes into stored clean sales and into stored sums, month by month.

The survivor of a transaction is the first of its valid copies, so the survivor of the store and
the one of the batch decide between them, and the result is what one run over all rows would give.
Only months that gain or lose a row are written again. The change is handed on as the rows added
and the rows removed, from which stored sums are brought up to date without reading the sales.

The dimensions must be the ones that the stored sales were built with.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.membership import may_have_key
from tallyline.plans import gold
from tallyline.plans.silver import SILVER_COLUMNS, TXN_COLUMNS, silver
from tallyline.sinks.publish import Published, recover, replace_units
from tallyline.sinks.scratch import fresh_path
from tallyline.sinks.tables import read_partitioned, write_table
from tallyline.sources.tables import Star

SILVER_FOLDERS = ("yyyymm", "region")
MONTH = "yyyymm"


@dataclass(frozen=True)
class Changes:
    """Clean sales that a batch has brought in and taken out, and the months they are in."""

    added: DataFrame
    removed: DataFrame
    months: tuple[str | None, ...]
    published: Published | None


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a scratch table: what it was computed from is about to be replaced."""
    path = fresh_path(df.sparkSession, name)
    write_table(df, path, dry_run=False)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_months(months: Sequence[str | None]) -> Column:
    """A condition on the folder column, so that no other month is listed or read."""
    known = [month for month in months if month is not None]
    found = F.col(MONTH).isin(known)
    return found | F.col(MONTH).isNull() if len(known) < len(months) else found


def store_silver(star: Star, path: str) -> T.StructType:
    """Write clean sales as the store; returns their schema."""
    clean = silver(star)
    write_table(clean, path, partition_by=SILVER_FOLDERS, dry_run=False)
    return clean.schema


def stored_silver(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = read_partitioned(spark, path, schema, SILVER_FOLDERS)
    return stored.select(*SILVER_COLUMNS)


def upsert_silver(star: Star, path: str) -> Changes:
    """Bring the transactions of ``star`` into the clean sales stored at ``path``.

    The store is read once for the ids and the order of copies, behind a Bloom filter of the
    batch's ids; whole rows are read of the touched months only. The list of months is the
    calendar's, so it is all that the driver sees.
    """
    spark = star.txns.sparkSession
    recover(spark, path)
    batch = _written(silver(star), "batch")
    stored = stored_silver(spark, path, batch.schema)

    order = F.struct(*TXN_COLUMNS[1:])
    ours = batch.select("txn_id", order.alias("new_order"))
    theirs = may_have_key(
        stored.select(*TXN_COLUMNS, MONTH), batch.select("txn_id"), "txn_id", batch.count()
    ).select("txn_id", MONTH, order.alias("old_order"))
    met = _written(
        theirs.join(ours, "txn_id").select(
            "txn_id", MONTH, (F.col("new_order") < F.col("old_order")).alias("wins")
        ),
        "met",
    )
    outdone = met.where("wins")
    fresh = batch.join(met.select("txn_id"), "txn_id", "left_anti")
    winners = batch.join(outdone.select("txn_id"), "txn_id", "left_semi")
    added = _written(fresh.unionByName(winners), "added")

    losing = [row[0] for row in outdone.select(MONTH).distinct().collect()]
    gaining = [row[0] for row in added.select(MONTH).distinct().collect()]
    removed = stored.where(in_months(losing)).join(outdone.select("txn_id"), "txn_id", "left_semi")
    removed = _written(removed, "removed")
    months = tuple({**dict.fromkeys(losing), **dict.fromkeys(gaining)})
    if not months:
        return Changes(added, removed, (), None)

    touched = stored.where(in_months(months))
    kept = touched.join(removed.select("txn_id"), "txn_id", "left_anti")
    published = replace_units(
        kept.unionByName(added), path, SILVER_FOLDERS, only=[(month,) for month in months]
    )
    return Changes(added, removed, months, published)


@dataclass(frozen=True)
class MonthlySums:
    """A stored table of sums and row counts by month and keys.

    Sums of disjoint sets of rows add up, and those of removed rows are subtracted, so the table
    is maintained from changes alone. Coarser tables, over fewer keys or all months, are sums of
    its rows. ``sums`` are exact: decimal or integer columns of the sales.
    """

    keys: tuple[str, ...]
    sums: tuple[str, ...]

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        return rows.groupBy(MONTH, *self.keys).agg(
            *[(sign * F.sum(name)).cast(_sum_type(rows, name)).alias(name) for name in self.sums],
            (sign * F.count(F.lit(1))).alias("row_count"),
        )

    def added_up(self, states: DataFrame, *by: str) -> DataFrame:
        """The states' rows added up by the given columns; groups without rows are gone."""
        names = (*self.sums, "row_count")
        return (
            states.groupBy(*by)
            .agg(*[F.sum(name).cast(states.schema[name].dataType).alias(name) for name in names])
            .where(F.col("row_count") != 0)
        )

    def store(self, sales: DataFrame, path: str) -> T.StructType:
        state = self.of(sales)
        write_table(state, path, partition_by=(MONTH,), dry_run=False)
        return state.schema

    def read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        return read_partitioned(spark, path, schema, (MONTH,))

    def apply(self, changes: Changes, path: str) -> Published | None:
        """Bring the table at ``path`` up to date: of each touched month the stored rows plus what
        was added minus what was removed."""
        if not changes.months:
            return None
        spark = changes.added.sparkSession
        recover(spark, path)
        delta = self.of(changes.added).unionByName(self.of(changes.removed, sign=-1))
        touched = self.read(spark, path, delta.schema).where(in_months(changes.months))
        state = self.added_up(touched.unionByName(delta), MONTH, *self.keys)
        return replace_units(state, path, (MONTH,), only=[(month,) for month in changes.months])


def _sum_type(rows: DataFrame, name: str) -> T.DataType:
    kind = rows.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.LongType()


#: The sums behind the business tables.
REGION_CATEGORY = MonthlySums(("region", "category"), ("total_amount", "quantity"))
CUSTOMERS = MonthlySums(("region", "customer_id"), ("total_amount",))
PRODUCTS = MonthlySums(("product_id", "product_name", "category"), ("total_amount", "quantity"))

#: Stored sums by the name of their table. They have the columns of sales that business tables
#: add up, so ``gold`` takes them in the place of the sales.
SUMS = {
    "sums_region_category": REGION_CATEGORY,
    "sums_customers": CUSTOMERS,
    "sums_products": PRODUCTS,
}


def gold_from_sums(sums: dict[str, DataFrame], top_n: int = gold.TOP_CUSTOMERS) -> dict[str, DataFrame]:
    """The business tables from stored sums."""
    return {
        "gold_monthly_region_cat": gold.monthly_region_category(sums["sums_region_category"]),
        "gold_top_customers": gold.top_customers(sums["sums_customers"], top_n),
        "gold_rev_trend": gold.revenue_trend(sums["sums_region_category"]),
        "gold_top_products": gold.top_products(sums["sums_products"]),
    }
