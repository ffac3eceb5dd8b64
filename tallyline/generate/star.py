"""Customers, products and transactions with numeric keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.draws import below, digest, pick
from tallyline.functions.geography import COUNTRIES, region_of_country

SEED = 42
END_DATE = date(2025, 8, 31)
DAYS_BACK = 270

# Sample words and the product tree.
FIRST_NAMES = (
    "Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gus", "Hana", "Ivo", "June",
    "Kai", "Lena", "Milo", "Nora", "Otto", "Pia", "Quin", "Rosa", "Sam", "Tess",
)
LAST_NAMES = (
    "Abbot", "Baker", "Carver", "Dyer", "Ellis", "Fisher", "Glover", "Hunter", "Ivers", "Joiner",
    "Keeler", "Lister", "Mason", "Naylor", "Osler", "Potter", "Quill", "Ryder", "Sawyer", "Turner",
)
GENDERS = ("Male", "Female", "Other")
CHANNELS = ("Online", "Store", "Marketplace")
SUBCATEGORIES = {
    "Electronics": ("Phone", "Laptop", "Headphones", "Camera", "Monitor"),
    "Clothing": ("Shirt", "Jeans", "Jacket", "Shoes", "Hoodie"),
    "Home & Kitchen": ("Blender", "Cookware", "Lamp", "Desk", "Chair"),
    "Sports": ("Ball", "Gloves", "Shoes", "Watch", "Mat"),
    "Toys": ("Doll", "Blocks", "Car", "Puzzle", "BoardGame"),
}


def person_name(digest_column: str):
    return F.concat_ws(
        " ", pick(digest_column, 1, 8, FIRST_NAMES), pick(digest_column, 9, 8, LAST_NAMES)
    )


def customers(ids: DataFrame, seed: int = SEED) -> DataFrame:
    drawn = ids.select("id", digest(seed, "customer", "id").alias("d")).select(
        "id", "d", pick("d", 33, 8, COUNTRIES).alias("country")
    )
    return drawn.select(
        F.col("id").cast("int").alias("customer_id"),
        person_name("d").alias("customer_name"),
        (below("d", 17, 8, 63) + 18).cast("int").alias("age"),
        pick("d", 25, 8, GENDERS).alias("gender"),
        "country",
        region_of_country("country").alias("region"),
    )


def products(ids: DataFrame, seed: int = SEED) -> DataFrame:
    by_category = F.create_map(
        *[
            part
            for category, names in SUBCATEGORIES.items()
            for part in (F.lit(category), F.array(*[F.lit(name) for name in names]))
        ]
    )
    drawn = ids.select("id", digest(seed, "product", "id").alias("d")).select(
        "id", "d", pick("d", 1, 8, tuple(SUBCATEGORIES)).alias("category")
    )
    position = below("d", 9, 8, 5).cast("int") + 1
    drawn = drawn.withColumn(
        "subcategory", F.element_at(F.element_at(by_category, F.col("category")), position)
    )
    cents = below("d", 17, 15, 149_501) + 500
    return drawn.select(
        F.col("id").cast("int").alias("product_id"),
        "category",
        "subcategory",
        F.format_string("%s-%s-%05d", "category", "subcategory", "id").alias("product_name"),
        (cents / 100).alias("base_price"),
    )


def transactions(
    ids: DataFrame,
    n_customers: int,
    n_products: int,
    seed: int = SEED,
    end: date = END_DATE,
    days_back: int = DAYS_BACK,
) -> DataFrame:
    """Sales of the ``days_back`` days up to ``end``, at any second of the day."""
    drawn = ids.select("id", digest(seed, "transaction", "id").alias("d"))
    day = F.date_sub(F.lit(end), below("d", 31, 8, days_back + 1).cast("int"))
    second = below("d", 39, 8, 86_400).cast("int")
    return drawn.select(
        F.format_string("TXN-%010d", "id").alias("txn_id"),
        F.timestamp_add("SECOND", second, day.cast("timestamp_ntz")).alias("txn_ts"),
        (below("d", 1, 15, n_customers) + 1).cast("int").alias("customer_id"),
        (below("d", 16, 15, n_products) + 1).cast("int").alias("product_id"),
        (below("d", 47, 8, 5) + 1).cast("int").alias("quantity"),
        pick("d", 55, 8, CHANNELS).alias("channel"),
    )
