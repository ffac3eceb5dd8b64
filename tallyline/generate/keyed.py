"""Customers, products and transactions with text keys, as the mode comparison uses them.

A foreign key is the key of a drawn index, so no list of keys is ever collected.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.draws import below, digest, key_text, pick
from tallyline.generate.star import SEED, person_name

START = date(2024, 1, 1)
END = date(2025, 8, 31)

# Sample words.
REGIONS = ("North", "South", "East", "West", "Central")
CATEGORIES = ("Electronics", "Clothing", "Home", "Books", "Toys", "Groceries")
CITIES = (
    "Ashford", "Brookdale", "Clayton", "Dunmore", "Eastport", "Fairview", "Glenwood", "Harbor",
    "Irving", "Juniper", "Kingsley", "Lakeside", "Milford", "Newbury", "Oakridge", "Pinehill",
)
WORDS = (
    "apron", "basket", "candle", "drawer", "easel", "folder", "goblet", "hammer",
    "inkpot", "jigsaw", "kettle", "ladder", "mirror", "napkin", "organ", "pillow",
)


def customers(ids: DataFrame, seed: int = SEED) -> DataFrame:
    drawn = ids.select("id", digest(seed, "keyed customer", "id").alias("d"))
    return drawn.select(
        key_text(seed, "keyed customer", "id").alias("customer_id"),
        person_name("d").alias("name"),
        pick("d", 17, 8, CITIES).alias("city"),
        pick("d", 25, 8, REGIONS).alias("region"),
    )


def products(ids: DataFrame, seed: int = SEED) -> DataFrame:
    drawn = ids.select("id", digest(seed, "keyed product", "id").alias("d"))
    return drawn.select(
        key_text(seed, "keyed product", "id").alias("product_id"),
        F.initcap(pick("d", 1, 8, WORDS)).alias("name"),
        pick("d", 9, 8, CATEGORIES).alias("category"),
        ((below("d", 17, 15, 14_001) + 1000) / 100).alias("price"),
    )


def transactions(
    ids: DataFrame,
    n_customers: int,
    n_products: int,
    seed: int = SEED,
    start: date = START,
    end: date = END,
) -> DataFrame:
    """Dates run from ``start`` to the day before ``end``."""
    drawn = ids.select("id", digest(seed, "keyed transaction", "id").alias("d"))
    day = F.date_add(F.lit(start), below("d", 31, 8, (end - start).days).cast("int"))
    return drawn.select(
        key_text(seed, "keyed transaction", "id").alias("transaction_id"),
        key_text(seed, "keyed customer", below("d", 1, 15, n_customers) + 1).alias("customer_id"),
        key_text(seed, "keyed product", below("d", 16, 15, n_products) + 1).alias("product_id"),
        (below("d", 47, 8, 5) + 1).cast("int").alias("quantity"),
        F.date_format(day, "yyyy-MM-dd").alias("transaction_date"),
    )
