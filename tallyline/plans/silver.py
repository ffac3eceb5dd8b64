"""Clean sales: enriched, filtered, one row per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.dates import month_key, order_date
from tallyline.functions.money import line_amount, price
from tallyline.operators.cleaning import first_copy
from tallyline.operators.joins import (
    BROADCAST_LIMIT_BYTES,
    join_dimensions,
    measured_bytes,
)
from tallyline.sources.tables import Star

CUSTOMER_COLUMNS = ("region", "gender")
PRODUCT_COLUMNS = ("category", "subcategory", "product_name", "base_price")

TXN_COLUMNS = ("txn_id", "txn_ts", "customer_id", "product_id", "quantity", "channel")

SILVER_COLUMNS = (
    "txn_id", "txn_ts", "customer_id", "product_id", "quantity", "channel",
    "region", "gender", "category", "subcategory", "product_name",
    "base_price", "unit_price", "total_amount", "order_date", "yyyymm",
)


def pruned_customers(customers: DataFrame, columns=CUSTOMER_COLUMNS) -> DataFrame:
    return customers.select("customer_id", *columns)


def pruned_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", *[name for name in PRODUCT_COLUMNS if name != "base_price"],
        price("base_price").alias("base_price"),
    )


def with_derived(df: DataFrame) -> DataFrame:
    """Line amount, order date and month key; ``unit_price`` must be there."""
    return df.withColumns(
        {
            "total_amount": line_amount(),
            "order_date": order_date(),
            "yyyymm": month_key(),
        }
    )


def enriched(star: Star, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Every transaction with its customer and product, unknown ones left NULL, once: the
    dimensions are made unique as for the clean sales."""
    customers, products = pruned_customers(star.customers), pruned_products(star.products)
    customers_fit, products_fit = _fitting(limit, customers, products)
    joined = join_dimensions(
        star.txns,
        [
            ("customer_id", _hinted(first_copy(customers, "customer_id"), customers_fit)),
            ("product_id", _hinted(unique_products(products), products_fit)),
        ],
        strategy="auto",
    )
    return with_derived(joined.withColumn("unit_price", F.col("base_price")))


def _fitting(limit: int, *dimensions: DataFrame) -> list[bool]:
    """Whether each dimension fits into a broadcast. Its rows are measured before they are made
    unique, so what is measured is an upper bound and costs no shuffle, and the unique rows are
    computed once, by the query alone."""
    return [size <= limit for size in measured_bytes(*dimensions)]


def _hinted(side: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(side) if fits else side


def unique_products(products: DataFrame) -> DataFrame:
    """One row for each product. Of several the cheapest one that can be sold counts, so a
    repeated key can neither multiply sales nor give two prices, whichever join is chosen."""
    attributes = [name for name in products.columns if name not in ("product_id", "base_price")]
    can_be_sold = F.coalesce(F.col("base_price") > 0, F.lit(False))
    return first_copy(products, "product_id", [F.desc(can_be_sold), "base_price", *attributes])


def sellable(products: DataFrame) -> DataFrame:
    """Products that can be sold, one row for each key: the price rule for known and unknown
    products alike. Without attributes the lowest price is all that has to be read."""
    sold = products.filter(F.col("base_price") > 0)
    if products.columns == ["product_id", "base_price"]:
        return sold.groupBy("product_id").agg(F.min("base_price").alias("base_price"))
    return unique_products(sold)


def unique_valid(txns: DataFrame, products: DataFrame, how: str) -> DataFrame:
    """Valid transactions, one row per ``txn_id``.

    Invalid copies go first, so a valid copy survives next to an invalid one.
    """
    bare = txns.select(*TXN_COLUMNS).filter(F.col("quantity") > 0)
    return first_copy(bare.join(products, "product_id", how), "txn_id", TXN_COLUMNS[1:])


def priced_sales(txns: DataFrame, products: DataFrame, products_are_small: bool) -> DataFrame:
    """Clean sales with the attributes of ``products``, which are sellable ones.

    Small products are joined twice by broadcast, first for their keys alone, so that the
    shuffle of the deduplication carries bare transactions. Large ones are joined once,
    before it: a second join would be another shuffle of the facts.
    """
    if products_are_small:
        products = F.broadcast(products)
        unique = unique_valid(txns, products, "left_semi").join(products, "product_id")
    else:
        unique = unique_valid(txns, products, "inner")
    return with_derived(unique.withColumn("unit_price", F.col("base_price")))


def sales(
    star: Star, limit: int = BROADCAST_LIMIT_BYTES, product_attributes: bool = True
) -> DataFrame:
    """Clean sales without customer attributes, or without any, for tables that need none."""
    products = pruned_products(star.products)
    if not product_attributes:
        products = products.select("product_id", "base_price")
    (fits,) = _fitting(limit, products)
    return priced_sales(star.txns, sellable(products), fits)


def sales_by_customer(
    star: Star, columns=CUSTOMER_COLUMNS, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Clean sales with chosen customer attributes; unknown customers stay, with NULLs.

    Customers are joined after the deduplication, which has then dropped the copies.
    """
    products = pruned_products(star.products)
    customers = pruned_customers(star.customers, columns)
    products_fit, customers_fit = _fitting(limit, products, customers)
    priced = priced_sales(star.txns, sellable(products), products_fit)
    unique = first_copy(customers, "customer_id")
    return priced.join(_hinted(unique, customers_fit), "customer_id", "left")


def customer_spend(
    star: Star, columns=("region",), limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """``customer_id``, ``total_spent`` and chosen attributes of every customer with sales.

    Sales are summed by customer before the join: a hot customer is reduced where its rows
    are, and the join moves one row for each customer, not the sales.
    """
    spent = (
        sales(star, limit, product_attributes=False)
        .groupBy("customer_id")
        .agg(F.sum("total_amount").alias("total_spent"))
    )
    customers = pruned_customers(star.customers, columns)
    (fits,) = _fitting(limit, customers)
    unique = first_copy(customers, "customer_id")
    return spent.join(_hinted(unique, fits), "customer_id", "left")


def count_sales(star: Star, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Rows of the clean sales. Counting ids needs no survivor, so nothing is sorted."""
    products = pruned_products(star.products).select("product_id", "base_price")
    (fits,) = _fitting(limit, products)
    products = _hinted(sellable(products), fits)
    ids = star.txns.filter(F.col("quantity") > 0).join(products, "product_id", "left_semi")
    return ids.select("txn_id").distinct().agg(F.count(F.lit(1)).alias("row_count"))


def silver(star: Star, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """The clean sales table."""
    return sales_by_customer(star, limit=limit).select(*SILVER_COLUMNS)
