"""Business tables over clean sales. Money stays decimal; see ``functions.money.doubles``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.ranking import top_overall, top_per_group
from tallyline.operators.trends import trailing_mean

TOP_CUSTOMERS = 10
TOP_PRODUCTS = 50

#: Reading order of each table; a minus sign means descending.
READING_ORDER = {
    "gold_monthly_region_cat": ("yyyymm", "region", "category"),
    "gold_top_customers": ("region", "rank", "customer_id"),
    "gold_rev_trend": ("yyyymm",),
    "gold_top_products": ("-revenue", "product_id"),
}


def monthly_region_category(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("yyyymm", "region", "category")
        .agg(F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"))
        .orderBy("yyyymm", "region", "category")
    )


def customer_spend(silver: DataFrame) -> DataFrame:
    """Spend by customer from stored clean sales; ``silver.customer_spend`` starts from a star."""
    return silver.groupBy("region", "customer_id").agg(
        F.sum("total_amount").alias("total_spent")
    )


def top_customers(
    silver: DataFrame, n: int = TOP_CUSTOMERS, method: str = "dense_rank"
) -> DataFrame:
    """Best customers of each region; unknown customers form the NULL region."""
    return top_spenders(customer_spend(silver), n, method)


def top_spenders(
    spend: DataFrame, n: int = TOP_CUSTOMERS, method: str = "dense_rank"
) -> DataFrame:
    """The same from spend by customer."""
    ranked = top_per_group(
        spend, "region", "total_spent", n, method, tie_break=["customer_id"]
    )
    return ranked.select("region", "customer_id", "total_spent", "rank").orderBy(
        "region", "rank", "customer_id"
    )


def monthly_total(silver: DataFrame) -> DataFrame:
    return silver.groupBy("yyyymm").agg(F.sum("total_amount").alias("revenue"))


def revenue_trend(silver: DataFrame) -> DataFrame:
    """Monthly revenue with the mean of the last three months that have sales."""
    mean = trailing_mean("revenue", "yyyymm", rows=3)
    return (
        monthly_total(silver).withColumn("rev_ma_3m", F.round(mean, 4)).orderBy("yyyymm")
    )


def revenue_trend_calendar(silver: DataFrame) -> DataFrame:
    """Monthly revenue with the mean over the last three calendar months that have sales: a
    month without sales shortens the frame instead of reaching further back."""
    month = F.col("yyyymm").cast("int")
    number = F.floor(month / 100) * 12 + month % 100
    mean = F.avg("revenue").over(Window.orderBy(number).rangeBetween(-2, 0))
    return (
        monthly_total(silver)
        .withColumn("rev_ma_3m", F.round(F.when(F.col("yyyymm").isNotNull(), mean), 4))
        .orderBy("yyyymm")
    )


def top_products(silver: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    revenue = silver.groupBy("product_id", "product_name", "category").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units")
    )
    return top_overall(revenue, "revenue", n, tie_break=["product_id"])


def gold_tables(silver: DataFrame, top_n: int = TOP_CUSTOMERS) -> dict[str, DataFrame]:
    return {
        "gold_monthly_region_cat": monthly_region_category(silver),
        "gold_top_customers": top_customers(silver, top_n),
        "gold_rev_trend": revenue_trend(silver),
        "gold_top_products": top_products(silver),
    }
