from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.generate import ids, keyed, star, states

MAKERS = {
    "customers": lambda i: star.customers(i),
    "products": lambda i: star.products(i),
    "transactions": lambda i: star.transactions(i, 100, 40),
    "keyed customers": lambda i: keyed.customers(i),
    "keyed products": lambda i: keyed.products(i),
    "keyed transactions": lambda i: keyed.transactions(i, 100, 40),
    "state sales": lambda i: states.state_sales(i),
    "state categories": lambda i: states.state_categories(i),
}
SCHEMAS = {
    "customers": schemas.CUSTOMERS,
    "products": schemas.PRODUCTS,
    "transactions": schemas.TRANSACTIONS,
    "keyed customers": schemas.KEYED_CUSTOMERS,
    "keyed products": schemas.KEYED_PRODUCTS,
    "keyed transactions": schemas.KEYED_TRANSACTIONS,
    "state sales": schemas.STATE_SALES,
    "state categories": schemas.STATE_CATEGORIES,
}


@pytest.mark.parametrize("name", MAKERS)
def test_rows_do_not_depend_on_partitions(spark, name):
    tables = [
        sorted(map(str, MAKERS[name](ids(spark, 500, parts)).collect())) for parts in (1, 3, 8)
    ]
    assert tables[0] == tables[1] == tables[2]


@pytest.mark.parametrize("name", MAKERS)
def test_schema(spark, name):
    assert not schemas.mismatches(MAKERS[name](ids(spark, 1)).schema, SCHEMAS[name])


def test_mismatches_are_named(spark):
    frame = spark.range(1).select(F.lit("x").alias("customer_id"))
    found = schemas.mismatches(frame.schema, schemas.CUSTOMERS)
    assert found[0] == "customer_id: string, expected int" and "age: missing" in found


def test_seed_changes_the_rows(spark):
    one, two = (star.customers(ids(spark, 200), seed).collect() for seed in (1, 2))
    assert one != two


def test_ranges(spark):
    people = star.customers(ids(spark, 5000))
    low, high = people.agg(F.min("age"), F.max("age")).first()
    assert (low, high) == (18, 80)
    assert {r[0] for r in people.select("gender").distinct().collect()} == set(star.GENDERS)
    prices = star.products(ids(spark, 5000)).agg(F.min("base_price"), F.max("base_price")).first()
    assert 5.0 <= prices[0] < 20 and 1450 < prices[1] <= 1500.0
    days = star.transactions(ids(spark, 20000), 10, 10).agg(
        F.min("txn_ts"), F.max("txn_ts"), F.min("quantity"), F.max("quantity")
    ).first()
    assert days[0] >= datetime(2024, 12, 4) and days[1] < datetime(2025, 9, 1)
    assert (days[2], days[3]) == (1, 5)
    dates = keyed.transactions(ids(spark, 20000), 10, 10).agg(
        F.min("transaction_date"), F.max("transaction_date")
    ).first()
    assert tuple(dates) == ("2024-01-01", "2025-08-30")
    sales = states.state_sales(ids(spark, 20000)).agg(F.min("sales"), F.max("sales")).first()
    assert tuple(sales) == (100, 1000)


def test_names_of_products_follow_the_tree(spark):
    for row in star.products(ids(spark, 300)).collect():
        assert row.subcategory in star.SUBCATEGORIES[row.category]
        assert row.product_name == f"{row.category}-{row.subcategory}-{row.product_id:05d}"


def test_keys(spark):
    txns = star.transactions(ids(spark, 3000), 100, 40)
    assert txns.filter("customer_id not between 1 and 100").count() == 0
    assert txns.filter("product_id not between 1 and 40").count() == 0
    assert txns.select("txn_id").distinct().count() == 3000
    assert txns.orderBy("txn_id").first().txn_id == "TXN-0000000001"


def test_text_keys_find_their_dimension(spark):
    facts = keyed.transactions(ids(spark, 3000), 100, 40)
    people, goods = keyed.customers(ids(spark, 100)), keyed.products(ids(spark, 40))
    joined = facts.join(people.select("customer_id"), "customer_id").join(
        goods.select("product_id"), "product_id"
    )
    assert joined.count() == 3000
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    assert facts.filter(~F.col("transaction_id").rlike(shape)).count() == 0
    assert facts.select("transaction_id").distinct().count() == 3000


def test_draws_are_even_and_do_not_repeat_across_partitions(spark):
    drawn = star.transactions(ids(spark, 8000, 8), 1_000_000, 1_000_000)
    assert drawn.select("customer_id").distinct().count() > 7900
    counts = [
        r["count"] for r in star.transactions(ids(spark, 30000), 6, 5).groupBy(
            "customer_id", "product_id"
        ).count().collect()
    ]
    assert len(counts) == 30 and all(850 < n < 1150 for n in counts)
    kinds = star.products(ids(spark, 25000)).groupBy("category", "subcategory").count().collect()
    assert len(kinds) == 25 and all(900 < r["count"] < 1100 for r in kinds)


def test_default_partitions_bound_the_rows_of_a_task(spark):
    assert ids(spark, 100_000_000).rdd.getNumPartitions() == 20
