"""Table schemas. Three separate families: star, keyed (string keys) and state sales."""

from __future__ import annotations

from pyspark.sql import types as T

#: One price and one order line. Money is exact decimal inside every plan.
PRICE = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(18, 2)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType(), False),
        T.StructField("customer_name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.IntegerType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("base_price", T.DoubleType()),
    ]
)

#: ``txn_ts`` is wall-clock time: its date and month do not depend on the session zone.
TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.StringType(), False),
        T.StructField("txn_ts", T.TimestampNTZType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("channel", T.StringType()),
    ]
)

KEYED_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

KEYED_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType(), False),
    ]
)

KEYED_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("transaction_date", T.StringType(), False),
    ]
)

STATE_SALES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("sales", T.LongType()),
    ]
)

STATE_CATEGORIES = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("category", T.LongType()),
    ]
)


def mismatches(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Names missing from ``actual`` or typed otherwise; nullability is not compared."""
    found = {field.name: field.dataType for field in actual}
    problems = []
    for field in expected:
        if field.name not in found:
            problems.append(f"{field.name}: missing")
        elif found[field.name] != field.dataType:
            problems.append(
                f"{field.name}: {found[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    return problems
