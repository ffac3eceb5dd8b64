"""Small literal stars."""

from datetime import datetime

from tallyline.sources.tables import Star

TXNS = (
    "txn_id string, txn_ts timestamp_ntz, customer_id bigint, product_id bigint, "
    "quantity int, channel string"
)
CUSTOMERS = (
    "customer_id bigint, customer_name string, age int, gender string, country string, "
    "region string"
)
PRODUCTS = (
    "product_id bigint, category string, subcategory string, product_name string, "
    "base_price double"
)


def txn(txn_id, customer_id, product_id, quantity, ts="2025-01-15 10:00:00", channel="Online"):
    when = datetime.fromisoformat(ts) if ts else None
    return (txn_id, when, customer_id, product_id, quantity, channel)


def star(spark, txns, customers=None, products=None):
    customers = customers if customers is not None else [(1, "North"), (2, "South")]
    products = products if products is not None else [(1, "Toys", 10.0), (2, "Books", 2.5)]
    return Star(
        spark.createDataFrame(txns, TXNS),
        spark.createDataFrame(
            [(key, f"c{key}", 30, "Other", "Peru", region) for key, region in customers],
            CUSTOMERS,
        ),
        spark.createDataFrame(
            [(key, category, "sub", f"p{key}", price) for key, category, price in products],
            PRODUCTS,
        ),
    )


def sales(spark, rows):
    """Clean sales from (region, customer_id, yyyymm, amount) tuples."""
    from decimal import Decimal

    return spark.createDataFrame(
        [(r, c, m, Decimal(str(a))) for r, c, m, a in rows],
        "region string, customer_id bigint, yyyymm string, total_amount decimal(18,2)",
    )
