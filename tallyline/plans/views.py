"""The same business tables in SQL, over registered views."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SILVER_VIEW = "silver_orders"

MONTHLY = f"""
SELECT yyyymm, region, category,
       CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       SUM(quantity) AS units
FROM {SILVER_VIEW}
GROUP BY yyyymm, region, category
ORDER BY yyyymm, region, category
"""

TOP_CUSTOMERS = f"""
WITH spend AS (
  SELECT region, customer_id, SUM(total_amount) AS total_spent
  FROM {SILVER_VIEW} GROUP BY region, customer_id
), totals AS (
  SELECT region, total_spent FROM spend GROUP BY region, total_spent
), ranked AS (
  SELECT * FROM (
    SELECT region, total_spent,
           DENSE_RANK() OVER (PARTITION BY region ORDER BY total_spent DESC) AS rank
    FROM totals)
  WHERE rank <= 10
)
SELECT s.region, s.customer_id, CAST(s.total_spent AS DOUBLE) AS total_spent, r.rank
FROM spend s JOIN ranked r ON s.region <=> r.region AND s.total_spent = r.total_spent
ORDER BY s.region, r.rank, s.customer_id
"""

TREND = f"""
WITH monthly AS (
  SELECT yyyymm, SUM(total_amount) AS revenue FROM {SILVER_VIEW} GROUP BY yyyymm
)
SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue,
       CAST(ROUND(AVG(revenue) OVER
         (ORDER BY yyyymm ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS DOUBLE) AS rev_ma_3m
FROM monthly
ORDER BY yyyymm
"""

TOP_PRODUCTS = f"""
SELECT product_id, product_name, category,
       CAST(SUM(total_amount) AS DOUBLE) AS revenue, SUM(quantity) AS units
FROM {SILVER_VIEW}
GROUP BY product_id, product_name, category
ORDER BY SUM(total_amount) DESC, product_id
LIMIT 50
"""


REVENUE_BY_MONTH = """
SELECT yyyymm, ROUND(SUM(revenue), 2) AS revenue, SUM(units) AS units
FROM gold_monthly_region_cat GROUP BY yyyymm
"""

FIRST_CUSTOMERS = """
SELECT region, customer_id, total_spent FROM gold_top_customers WHERE rank = 1
"""

MONTHS_ABOVE_TREND = """
SELECT yyyymm, revenue, rev_ma_3m FROM gold_rev_trend WHERE revenue > rev_ma_3m
"""

PRODUCTS_BY_CATEGORY = """
SELECT category, COUNT(*) AS products, SUM(units) AS units FROM gold_top_products GROUP BY category
"""


def register(frames: Mapping[str, DataFrame]) -> None:
    """Make frames known to SQL under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def over_silver(spark: SparkSession, silver: DataFrame, statement: str) -> DataFrame:
    """Run a statement with ``silver`` as the clean sales view."""
    return _over(spark, {SILVER_VIEW: silver}, statement)


def over_gold(
    spark: SparkSession, tables: Mapping[str, DataFrame], statement: str
) -> DataFrame:
    """Run a statement with the business tables as views."""
    return _over(spark, tables, statement)


def _over(spark: SparkSession, frames: Mapping[str, DataFrame], statement: str) -> DataFrame:
    """The frames stand for their names in this statement alone: views that the session has
    under these names stay as they are."""
    for name in frames:
        statement = re.sub(rf"\b{name}\b", "{" + name + "}", statement)
    return spark.sql(statement, **frames)
