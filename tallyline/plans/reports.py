"""Reports on top of the clean sales and the business tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.cleaning import banded
from tallyline.operators.ranking import top_per_group
from tallyline.operators.trends import growth_percent, share_of_total, trailing_mean
from tallyline.plans.gold import READING_ORDER, customer_spend, monthly_total

# The lower age of each band.
AGE_BANDS = {"18-24": 18, "25-34": 25, "35-44": 35, "45-54": 45, "55-64": 55, "65+": 65}


def category_share(sales: DataFrame) -> DataFrame:
    revenue = sales.groupBy("category").agg(F.sum("total_amount").alias("revenue"))
    return revenue.withColumn("share", share_of_total("revenue"))


def month_growth(sales: DataFrame) -> DataFrame:
    return monthly_total(sales).withColumn("growth_pct", growth_percent("revenue", "yyyymm"))


def sales_by_age_group(sales: DataFrame) -> DataFrame:
    """Revenue and buyers per age band; ``sales`` must carry ``age``."""
    band = banded("age", AGE_BANDS, below="<18", missing="unknown")
    return (
        sales.withColumn("age_group", band)
        .groupBy("age_group")
        .agg(
            F.sum("total_amount").alias("revenue"),
            F.countDistinct("customer_id").alias("customers"),
        )
    )


def spend_by_age_group(spend: DataFrame) -> DataFrame:
    """The same from spend by customer, which must carry ``age``: one row for each customer,
    so buyers need no distinct count."""
    band = banded("age", AGE_BANDS, below="<18", missing="unknown")
    return (
        spend.withColumn("age_group", band)
        .groupBy("age_group")
        .agg(F.sum("total_spent").alias("revenue"), F.count("customer_id").alias("customers"))
    )


def region_revenue(silver: DataFrame) -> DataFrame:
    return silver.groupBy("region").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units")
    )


def count_by_region(silver: DataFrame) -> DataFrame:
    return silver.groupBy("region").agg(F.count(F.lit(1)).alias("row_count"))


def region_category_kpis(silver: DataFrame) -> DataFrame:
    totals = silver.groupBy("region", "category").agg(
        F.sum("total_amount").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count("txn_id").alias("orders"),
    )
    mean = F.try_divide(F.col("revenue").cast("double"), F.col("orders"))
    return totals.withColumn("avg_order_value", F.round(mean, 4))


def region_report(silver: DataFrame, n: int = 5) -> DataFrame:
    """Revenue of each region beside its best customers."""
    return spend_report(customer_spend(silver), n)


def spend_report(spend: DataFrame, n: int = 5) -> DataFrame:
    """The same from spend by customer."""
    revenue = spend.groupBy(F.col("region").alias("_region")).agg(
        F.sum("total_spent").alias("region_revenue")
    )
    best = top_per_group(spend, "region", "total_spent", n)
    return (
        best.join(revenue, F.col("region").eqNullSafe(F.col("_region")))
        .select("region", "region_revenue", "rank", "customer_id", "total_spent")
        .orderBy("region", "rank", "customer_id")
    )


def monthly_report(sales: DataFrame) -> DataFrame:
    return (
        monthly_total(sales)
        .withColumns(
            {
                "rev_ma_3m": F.round(trailing_mean("revenue", "yyyymm", rows=3), 4),
                "growth_pct": growth_percent("revenue", "yyyymm"),
            }
        )
        .orderBy("yyyymm")
    )


def category_report(sales: DataFrame) -> DataFrame:
    return category_share(sales).orderBy(F.desc("share"), "category")


def silver_sample(silver: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of the clean sales, by transaction id."""
    return (
        silver.select(
            "txn_id", "order_date", "region", "category",
            "quantity", "unit_price", "total_amount", "yyyymm",
        )
        .orderBy("txn_id")
        .limit(n)
    )


def head(table: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``; a minus sign before a column means descending."""
    keys = [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]
    return table.orderBy(*keys).limit(n)


def head_reports(gold: Mapping[str, DataFrame], n: int = 8) -> dict[str, DataFrame]:
    """The first rows of each business table in its reading order."""
    return {name: head(table, READING_ORDER[name], n) for name, table in gold.items()}
