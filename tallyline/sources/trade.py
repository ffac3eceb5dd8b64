"""The order tables (lineitem, orders, customer, part, ...) seen as a retail star.

All rows of all tables take part. The source is clean, so some facts are marked as dirty
by value, the way a shop would meet them:

* a low-priority order is a guest checkout: its customer id is in no customer table;
* a line taxed at 8 % is for an unlisted product: its product id is in no product table;
* a returned and settled line has a negative quantity, an untaxed accepted line quantity 0;
* a product of size 1 is a free sample (price 0), one of size 50 has no price yet;
* the age of a customer deep in debt is not known.

``txn_id`` repeats in the source, which gives deduplication real work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.geography import COUNTRIES
from tallyline.functions.money import price
from tallyline.sources.tables import Star, read_table


#: What ``transactions_of`` reads of the two fact tables.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus",
)
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def transactions_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    # Orders grow like the lines: neither side is ever broadcast.
    orders = orders.hint("merge")
    guest = F.col("o_orderpriority") == "5-LOW"
    unlisted = F.col("l_tax") == F.lit(0.08)
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    voided = (F.col("l_returnflag") == "A") & (F.col("l_tax") == F.lit(0.0))
    quantity = F.col("l_quantity").cast("int")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("TXN-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("txn_id"),
        F.col("o_orderdate").alias("txn_ts"),
        F.when(guest, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(unlisted, -1 - F.col("l_partkey"))
        .otherwise(F.col("l_partkey"))
        .alias("product_id"),
        F.when(returned, -quantity).when(voided, 0).otherwise(quantity).alias("quantity"),
        F.col("l_returnflag").alias("channel"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geography = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    age = (F.floor((F.col("c_acctbal") + 1000) / 175) + 18).cast("int")
    return (
        table(spark, sf_dir, "customer")
        .join(geography, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.when(F.col("c_acctbal") >= -500, age).alias("age"),
            F.col("c_mktsegment").alias("gender"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = price("p_retailprice")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") == 1, price(F.lit(0)))
        .when(F.col("p_size") < 50, listed)
        .alias("base_price"),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(
        transactions(spark, sf_dir), customers(spark, sf_dir), products(spark, sf_dir)
    )


def nation_country(key: str) -> Column:
    """The named country of a nation key."""
    names = F.array(*[F.lit(name) for name in COUNTRIES])
    return F.element_at(names, F.col(key).cast("int") + 1)


def state_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: id, buyer name, state, sales."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("state"),
            price("o_totalprice").alias("sales"),
        )
    )


def state_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories 1 to 5 served in each state: a state may have several, or none.

    One row per pair, so the table is bounded by states times categories.
    """
    category = (F.floor((F.col("s_acctbal") + 1000) / 2200) + 1).cast("bigint")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("state"), category.alias("category"))
        .distinct()
    )
