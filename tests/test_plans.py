"""What the plans must look like."""

import pytest

from tallyline.catalog import QUERIES
from tallyline.jobs.compare import join_types, plan_text
from tallyline.jobs.generate import star_frames, write_star
from tallyline.plans import gold, modes, reports
from tallyline.plans.silver import pruned_customers, pruned_products, sales, silver
from tallyline.sources.tables import read_star

SF_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("EvalPython", "MapInPandas", "FlatMapGroups", "MapPartitions")
FORBIDDEN = (*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def stored_star(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("star"))
    write_star(star_frames(spark, 200, 50, 5000), base, dry_run=False)
    return read_star(spark, base)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_DIR))
    assert not [node for node in FORBIDDEN if node in plan]


def test_filters_reach_the_scan(spark, stored_star):
    plan = formatted(sales(stored_star))
    assert "GreaterThan(quantity,0)" in plan
    assert "IsNotNull(product_id)" in plan


def formatted(df):
    import contextlib
    import io

    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()


def test_scans_read_only_needed_columns(spark, stored_star):
    plan = formatted(gold.monthly_total(sales(stored_star, product_attributes=False)))
    assert "customer_name" not in plan and "subcategory" not in plan and "gender" not in plan


def test_monthly_total_shuffles_twice(spark, stored_star):
    """The sales, that is; the products are made unique by key beside them."""
    plan = plan_text(gold.monthly_total(sales(stored_star, product_attributes=False)))
    assert plan.count("Exchange hashpartitioning(txn_id") == 1
    assert plan.count("Exchange hashpartitioning(yyyymm") == 1
    others = plan.count("Exchange hashpartitioning(product_id")
    assert plan.count("Exchange hashpartitioning") == 2 + others


def test_top_products_is_a_bounded_sort(spark, stored_star):
    assert "TakeOrderedAndProject" in plan_text(gold.top_products(sales(stored_star)))


@pytest.mark.parametrize(
    "table",
    [
        gold.top_customers,
        lambda clean: gold.top_customers(clean, method="rank"),
        reports.region_report,
    ],
)
def test_spend_is_computed_once(spark, stored_star, table):
    frame = table(silver(stored_star))
    frame.collect()
    final = plan_text(frame).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("Exchange hashpartitioning(txn_id") == 1
    assert "WindowGroupLimit [region" in final


def test_join_type_of_each_mode(spark, stored_star):
    dimensions = [
        ("customer_id", pruned_customers(stored_star.customers)),
        ("product_id", pruned_products(stored_star.products)),
    ]
    expected = {
        "baseline": ["SortMergeJoin"],
        "broadcast": ["BroadcastHashJoin"],
        "full": ["BroadcastHashJoin"],
    }
    for mode, types in expected.items():
        with modes.joined(mode, stored_star.txns, dimensions, ["region"]) as frame:
            counts = reports.count_by_region(frame)
            counts.collect()
            assert join_types(counts) == types
            assert frame.is_cached == (mode == "full")
        assert not frame.is_cached
    with pytest.raises(ValueError), modes.joined("other", stored_star.txns, [], []):
        pass


def test_frame_is_released_after_an_error(spark):
    from tallyline.operators.layout import persisted

    frame = spark.range(10)
    with pytest.raises(RuntimeError), persisted(frame):
        assert frame.is_cached
        raise RuntimeError
    assert not frame.is_cached


def test_spread_splits_a_hot_key(spark):
    from pyspark.sql import functions as F

    from tallyline.operators.layout import partition_profile, spread_by_keys

    frame = spark.range(0, 6000, 1, 6).withColumn(
        "k", F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))
    )
    plain = partition_profile(spread_by_keys(frame, 8, "k")).collect()
    split = partition_profile(spread_by_keys(frame, 8, "k", spread=8)).collect()
    assert max(r.row_count for r in plain) >= 4000
    assert max(r.row_count for r in split) < 2500
    assert sum(r.row_count for r in split) == 6000
    by_key = spread_by_keys(frame, None, "k")
    assert sorted(by_key.collect()) == sorted(frame.collect())


def test_spread_splits_equal_rows_by_their_key(spark):
    from pyspark.sql import functions as F

    from tallyline.operators.layout import balance, partition_profile, spread_by_keys

    frame = spark.range(0, 60_000, 1, 2).select(
        "id", F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("region")
    )
    spread = spread_by_keys(frame, 32, "region", spread=32, row_key=["id"]).select("region")
    sizes = [row.row_count for row in partition_profile(spread).collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 4 * 60_000 / 32
    assert tuple(balance(spread, 32).first()) == (60_000, True, True)
    assert tuple(balance(frame.limit(0), 4).first()) == (0, True, True)


def test_task_counts_follow_the_data():
    from tallyline.jobs.generate import keyed_files
    from tallyline.operators.layout import tasks_for
    from tallyline.session import initial_partitions

    assert tasks_for(10, 16) == 16 and tasks_for(10**9, 16) == 1000
    assert keyed_files(200_000) == 16 and keyed_files(10**10) == 2000
    assert initial_partitions(10**9) == 200
    assert initial_partitions(100 * 2**40) == 100 * 2**13


def test_a_hot_customer_is_summed_before_the_join(spark, set_conf):
    """With broadcast off the sales of a customer are reduced below the customer join."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    )
    from frames import star, txn

    from tallyline.plans.silver import customer_spend

    txns = [txn(f"t{n}", 1 if n % 5 < 3 else n % 40, 1, 1) for n in range(500)]
    given = star(spark, txns, customers=[(key, f"r{key % 3}") for key in range(40)])
    for table in (
        gold.top_spenders(customer_spend(given, limit=0)),
        reports.spend_report(customer_spend(given, limit=0)),
        reports.spend_by_age_group(customer_spend(given, ("age",), limit=0)),
    ):
        plan = plan_text(table).split("== Initial Plan ==")[0]
        join = plan.index("SortMergeJoin [customer_id")
        assert "partial_sum(total_amount" in plan[join:]


def test_a_month_and_region_read_one_folder(spark, tmp_path):
    from frames import star, txn

    from tallyline.sinks.tables import read_partitioned, write_table

    txns = [txn(f"t{n}", n % 4, 1, 1, ts=f"2025-0{1 + n % 3}-01 00:00:00") for n in range(60)]
    rows = silver(star(spark, txns))
    path = str(tmp_path / "silver")
    folders = ("yyyymm", "region")
    write_table(rows, path, partition_by=folders, dry_run=False)
    stored = read_partitioned(spark, path, rows.schema, folders)
    one = stored.where("yyyymm = '202502' and region = 'South'")
    plan = formatted(one)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "yyyymm" in filters and "202502" in filters and "South" in filters
    assert one.count() == rows.where("yyyymm = '202502' and region = 'South'").count() > 0


def test_sql_over_views_leaves_the_sessions_views_alone(spark):
    from tallyline.plans import views

    spark.range(3).createOrReplaceTempView("silver_orders")
    frame = spark.createDataFrame(
        [("202501", "R", "C", 2, 1.5)], "yyyymm string, region string, category string, quantity int, total_amount double"
    )
    assert views.over_silver(spark, frame, views.MONTHLY).first().revenue == 1.5
    assert spark.table("silver_orders").count() == 3
    spark.catalog.dropTempView("silver_orders")


def test_full_mode_keeps_one_frame_in_n_partitions(spark, stored_star):
    dimensions = [("customer_id", pruned_customers(stored_star.customers)), ("product_id", pruned_products(stored_star.products))]
    columns = ["region", "category", "quantity"]
    with modes.joined("full", stored_star.txns, dimensions, columns, partitions=13) as frame:
        assert frame.rdd.getNumPartitions() == 13
        for key in ("region", "category"):
            plan = frame.groupBy(key).count()._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan
        assert frame.is_cached
    assert not frame.is_cached
