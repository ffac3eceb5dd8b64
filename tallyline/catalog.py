"""Every operator as a named query over the order tables in a directory."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.dates import month_key, month_part, order_date, year_part
from tallyline.functions.draws import below, digest, key_text
from tallyline.functions.geography import region_of_country
from tallyline.functions.money import doubles, line_amount
from tallyline.functions.text import tidy_name
from tallyline.generate import ids, keyed, states
from tallyline.generate import star as generated
from tallyline.operators import cleaning, clustering, constraints, joins, layout, profile
from tallyline.plans import cubes, gold, incremental, modes, reports, views
from tallyline.plans import silver as clean
from tallyline.sinks.buckets import store_by_key
from tallyline.sinks.publish import replace_units
from tallyline.sinks.scratch import fresh_path
from tallyline.sinks.tables import (
    read_partitioned,
    write_by_month,
    write_csv,
    write_table,
)
from tallyline.sources import delimited, inference, tables, trade
from tallyline.sources.tables import Star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Fewest tasks of a set number; larger tables get more.
LEAST_TASKS = 16
HEAD = 8
SILVER_FOLDERS = ("yyyymm", "region")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.sales(trade.star(spark, sf_dir))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.sales(trade.star(spark, sf_dir), product_attributes=False)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver(trade.star(spark, sf_dir))


def _spend(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return clean.customer_spend(trade.star(spark, sf_dir), columns or ("region",))


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the transactions; their count comes from the file footers."""
    return layout.tasks_for(trade.table(spark, sf_dir, "lineitem").count(), LEAST_TASKS)


# Sources


@query
def scan_parquet(spark, sf_dir):
    lines = tables.read_table(spark, f"{sf_dir}/lineitem.parquet")
    return lines.select("l_orderkey", "l_partkey", "l_quantity")


@query
def scan_guarded(spark, sf_dir):
    if tables.read_if_present(spark, f"{sf_dir}/no_such_table.parquet") is not None:
        raise AssertionError("a table that is not there was read")
    present = tables.read_if_present(spark, f"{sf_dir}/orders.parquet")
    return present.select("o_orderkey", "o_custkey", "o_orderstatus")


def _raw_csv(spark, sf_dir):
    """Transactions as CSV, with quantities that will not cast on one channel."""
    path = fresh_path(spark, "raw_txns")
    raw = trade.transactions(spark, sf_dir).withColumn(
        "quantity",
        F.concat(
            F.col("quantity").cast("string"), F.when(F.col("channel") == "N", "x").otherwise("")
        ),
    )
    write_csv(raw, path, dry_run=False)
    return path


@query
def scan_csv_typed(spark, sf_dir):
    """Text with quantities that will not cast: ``x`` is appended on one channel."""
    path = _raw_csv(spark, sf_dir)
    schema = T.StructType(
        [
            T.StructField("txn_id", T.StringType()),
            T.StructField("txn_ts", T.TimestampNTZType()),
            T.StructField("customer_id", T.LongType()),
            T.StructField("product_id", T.LongType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("channel", T.StringType()),
        ]
    )
    return delimited.read_typed_csv(spark, path, schema)


@query
def scan_csv_inferred(spark, sf_dir):
    """The type of every column of the same text, and how many values do not fit it."""
    _, report = inference.infer_csv(spark, _raw_csv(spark, sf_dir), tolerance=0.5)
    return report.drop("place")


@query
def scan_csv_inferred_rows(spark, sf_dir):
    """The same text read with the types found."""
    path = _raw_csv(spark, sf_dir)
    schema, _ = inference.infer_csv(spark, path, tolerance=0.5)
    return delimited.read_typed_csv(spark, path, schema)


# Synthetic tables: one row for each row of the given table


@query
def gen_ids(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    return rows.select("id", F.format_string("TXN-%010d", "id").alias("txn_key"))


@query
def gen_customers(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "customer")
    return generated.customers(rows.select((F.col("c_custkey") + 1).alias("id")))


@query
def gen_products(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "part")
    return generated.products(rows.select((F.col("p_partkey") + 1).alias("id")))


def _dimension_sizes(spark, sf_dir):
    return [trade.table(spark, sf_dir, name).count() for name in ("customer", "part")]


@query
def gen_txns(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    return generated.transactions(rows, *_dimension_sizes(spark, sf_dir))


@query
def gen_bench_customers(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "customer")
    return keyed.customers(rows.select((F.col("c_custkey") + 1).alias("id")))


@query
def gen_bench_products(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "part")
    return keyed.products(rows.select((F.col("p_partkey") + 1).alias("id")))


@query
def gen_bench_txns(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    return keyed.transactions(rows, *_dimension_sizes(spark, sf_dir))


@query
def gen_bench_tables(spark, sf_dir):
    """The three text-keyed tables joined: every foreign key finds its dimension row."""
    return joins.join_dimensions(
        gen_bench_txns(spark, sf_dir),
        [
            (
                "customer_id",
                gen_bench_customers(spark, sf_dir).withColumnRenamed("name", "customer_name"),
            ),
            (
                "product_id",
                gen_bench_products(spark, sf_dir).withColumnRenamed("name", "product_name"),
            ),
        ],
        how="inner",
    )


@query
def gen_state_sales(spark, sf_dir):
    rows = trade.table(spark, sf_dir, "orders")
    return states.state_sales(rows.select((F.col("o_orderkey") + 1).alias("id")))


@query
def gen_state_category_sum(spark, sf_dir):
    return joins.fanned_out_sum(
        gen_state_sales(spark, sf_dir),
        states.state_categories(ids(spark, states.CATEGORY_ROWS, 1)),
        "state",
        "category",
        "sales",
    )


# Projections, filters, cleaning


@query
def project_prune(spark, sf_dir):
    return clean.pruned_customers(trade.customers(spark, sf_dir))


@query
def derive_line_amount(spark, sf_dir):
    products = clean.pruned_products(trade.products(spark, sf_dir))
    joined = joins.join_dimensions(
        trade.transactions(spark, sf_dir), [("product_id", products)]
    ).withColumn("unit_price", F.col("base_price"))
    return joined.select(
        "txn_id",
        "product_id",
        "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        line_amount().cast("double").alias("total_amount"),
    )


@query
def coalesce_price(spark, sf_dir):
    priced = cleaning.zero_missing_price(clean.enriched(trade.star(spark, sf_dir)))
    return doubles(priced.select("txn_id", "product_id", "unit_price"), "unit_price")


@query
def derive_dates(spark, sf_dir):
    return trade.transactions(spark, sf_dir).select(
        "txn_id",
        "txn_ts",
        order_date().alias("order_date"),
        month_key().alias("yyyymm"),
        year_part().alias("year"),
        month_part().alias("month"),
    )


@query
def map_region(spark, sf_dir):
    country = trade.nation_country("c_nationkey")
    return (
        trade.table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("customer_id"), country.alias("country"))
        .withColumn("region", region_of_country("country"))
    )


@query
def scalar_suite(spark, sf_dir):
    """Zero-padded keys, rounding, draws, date arithmetic, text and lookups, per order."""
    status = F.create_map(
        F.lit("O"), F.lit("Open"), F.lit("F"), F.lit("Filled"), F.lit("P"), F.lit("Partial")
    )
    key = F.col("o_orderkey")
    orders = trade.table(spark, sf_dir, "orders").withColumn("d", digest(42, "order", key))
    day_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        key.alias("id"),
        F.format_string("TXN-%010d", key).alias("padded_ten"),
        F.format_string("%05d", "o_custkey").alias("padded_five"),
        F.round(F.col("o_totalprice") / 3, 2).alias("rounded"),
        below("d", 1, 8, 6).alias("drawn"),
        key_text(42, "order", key).alias("key_text"),
        F.date_sub("o_orderdate", 30).alias("month_before"),
        F.timestamp_add("SECOND", below("d", 9, 8, 86_400).cast("int"), "o_orderdate").alias(
            "at_second"
        ),
        day_text.alias("day_text"),
        F.to_date(day_text, "yyyy-MM-dd").alias("day_parsed"),
        F.initcap(F.substring("o_orderpriority", 3, 20)).alias("capitalised"),
        F.col("o_orderstatus").isin("O", "F").alias("is_settled"),
        F.element_at(status, F.col("o_orderstatus")).alias("status_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("cast_int"),
        F.col("o_orderpriority").try_cast("int").alias("cast_failed"),
    )


_CLEANED = ("txn_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount")


@query
def clean_filter(spark, sf_dir):
    kept = cleaning.keep_valid(clean.enriched(trade.star(spark, sf_dir)))
    return doubles(kept.select(*_CLEANED), "unit_price", "total_amount")


@query
def clean_filter_zero_price(spark, sf_dir):
    """The other spelling of the price rule; the same rows survive."""
    zeroed = cleaning.zero_missing_price(clean.enriched(trade.star(spark, sf_dir)))
    kept = cleaning.keep_positive(clean.with_derived(zeroed))
    return doubles(kept.select(*_CLEANED), "unit_price", "total_amount")


@query
def clean_nulls(spark, sf_dir):
    filled = cleaning.fill_unknown(
        clean.enriched(trade.star(spark, sf_dir)), ["region", "gender", "category"]
    )
    return doubles(
        filled.select("txn_id", "product_id", "region", "gender", "category", "base_price"),
        "base_price",
    )


@query
def null_profile(spark, sf_dir):
    return cleaning.null_profile(clean.enriched(trade.star(spark, sf_dir)))


@query
def clean_text(spark, sf_dir):
    untidy = F.concat(
        F.lit("  "), F.upper(F.regexp_replace("p_name", " ", "   ")), F.lit("\t")
    )
    return trade.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), tidy_name(untidy).alias("product_name")
    )


@query
def dedup_txn(spark, sf_dir):
    return cleaning.first_copy(trade.transactions(spark, sf_dir), "txn_id")


@query
def silver_orders(spark, sf_dir):
    return doubles(_silver(spark, sf_dir), "base_price", "unit_price", "total_amount")


# Joins

_JOINED = ("txn_id", "customer_id", "product_id", "quantity", "region", "category", "base_price")


def _joined(spark, sf_dir, how, strategy):
    star = trade.star(spark, sf_dir)
    joined = joins.join_dimensions(
        star.txns,
        [
            ("customer_id", clean.pruned_customers(star.customers)),
            ("product_id", clean.pruned_products(star.products)),
        ],
        how=how,
        strategy=strategy,
    )
    return doubles(joined.select(*_JOINED), "base_price")


@query
def join_left_broadcast(spark, sf_dir):
    return _joined(spark, sf_dir, "left", "broadcast")


@query
def join_inner_shuffle(spark, sf_dir):
    return _joined(spark, sf_dir, "inner", "merge")


@query
def join_inner_broadcast(spark, sf_dir):
    return _joined(spark, sf_dir, "inner", "broadcast")


def _fan_out(spark, sf_dir, strategy):
    return joins.fan_out(
        doubles(trade.state_sales(spark, sf_dir), "sales"),
        trade.state_categories(spark, sf_dir),
        "state",
        strategy,
    )


@query
def join_fanout(spark, sf_dir):
    return _fan_out(spark, sf_dir, "auto")


@query
def join_fanout_broadcast(spark, sf_dir):
    return _fan_out(spark, sf_dir, "broadcast")


@query
def sum_by_category(spark, sf_dir):
    total = joins.fanned_out_sum(
        trade.state_sales(spark, sf_dir),
        trade.state_categories(spark, sf_dir),
        "state",
        "category",
        "sales",
    )
    return doubles(total, "sales")


# Business tables


@query
def gold_monthly_region_cat(spark, sf_dir):
    return doubles(gold.monthly_region_category(_silver(spark, sf_dir)), "revenue")


@query
def top_customers_region(spark, sf_dir):
    return doubles(gold.top_spenders(_spend(spark, sf_dir)), "total_spent")


@query
def top5_customers_region(spark, sf_dir):
    return doubles(gold.top_spenders(_spend(spark, sf_dir), n=5), "total_spent")


@query
def top_customers_rank(spark, sf_dir):
    return doubles(gold.top_spenders(_spend(spark, sf_dir), method="rank"), "total_spent")


@query
def top_customers_row_number(spark, sf_dir):
    top = gold.top_spenders(_spend(spark, sf_dir), method="row_number")
    return doubles(top, "total_spent")


@query
def gold_rev_trend(spark, sf_dir):
    return doubles(gold.revenue_trend(_amounts(spark, sf_dir)), "revenue", "rev_ma_3m")


@query
def rev_trend_calendar(spark, sf_dir):
    trend = gold.revenue_trend_calendar(_amounts(spark, sf_dir))
    return doubles(trend, "revenue", "rev_ma_3m")


@query
def gold_top_products(spark, sf_dir):
    return doubles(gold.top_products(_sales(spark, sf_dir)), "revenue")


@query
def customer_spend(spark, sf_dir):
    spend = _spend(spark, sf_dir).select("region", "customer_id", "total_spent")
    return doubles(spend, "total_spent")


@query
def monthly_total(spark, sf_dir):
    return doubles(gold.monthly_total(_amounts(spark, sf_dir)), "revenue")


@query
def silver_count(spark, sf_dir):
    return clean.count_sales(trade.star(spark, sf_dir))


# Reports


@query
def category_share(spark, sf_dir):
    return doubles(reports.category_share(_sales(spark, sf_dir)), "revenue")


@query
def mom_growth(spark, sf_dir):
    return doubles(reports.month_growth(_amounts(spark, sf_dir)), "revenue")


@query
def sales_by_age_group(spark, sf_dir):
    return doubles(reports.spend_by_age_group(_spend(spark, sf_dir, "age")), "revenue")


@query
def count_by_region(spark, sf_dir):
    return reports.count_by_region(_silver(spark, sf_dir))


@query
def region_revenue(spark, sf_dir):
    return doubles(reports.region_revenue(_silver(spark, sf_dir)), "revenue")


@query
def region_category_kpis(spark, sf_dir):
    return doubles(reports.region_category_kpis(_silver(spark, sf_dir)), "revenue")


@query
def report_silver_sample(spark, sf_dir):
    sample = reports.silver_sample(_silver(spark, sf_dir))
    return doubles(sample, "unit_price", "total_amount")


@query
def report_region(spark, sf_dir):
    report = reports.spend_report(_spend(spark, sf_dir))
    return doubles(report, "region_revenue", "total_spent")


@query
def report_monthly(spark, sf_dir):
    return doubles(reports.monthly_report(_amounts(spark, sf_dir)), "revenue", "rev_ma_3m")


@query
def report_category(spark, sf_dir):
    return doubles(reports.category_report(_sales(spark, sf_dir)), "revenue")


def _head(name, table):
    return reports.head(table, gold.READING_ORDER[name], HEAD)


@query
def report_head_monthly(spark, sf_dir):
    return _head("gold_monthly_region_cat", gold_monthly_region_cat(spark, sf_dir))


@query
def report_head_top_customers(spark, sf_dir):
    return _head("gold_top_customers", top_customers_region(spark, sf_dir))


@query
def report_head_trend(spark, sf_dir):
    return _head("gold_rev_trend", gold_rev_trend(spark, sf_dir))


@query
def report_head_top_products(spark, sf_dir):
    return _head("gold_top_products", gold_top_products(spark, sf_dir))


# SQL over the registered view


@query
def sql_view_monthly(spark, sf_dir):
    return views.over_silver(spark, _silver(spark, sf_dir), views.MONTHLY)


@query
def sql_view_top_customers(spark, sf_dir):
    return views.over_silver(spark, _silver(spark, sf_dir), views.TOP_CUSTOMERS)


@query
def sql_view_trend(spark, sf_dir):
    return views.over_silver(spark, _silver(spark, sf_dir), views.TREND)


@query
def sql_view_top_products(spark, sf_dir):
    return views.over_silver(spark, _silver(spark, sf_dir), views.TOP_PRODUCTS)


@query
def sql_gold_monthly(spark, sf_dir):
    """Revenue by month over the registered table."""
    return views.over_gold(spark, _gold(spark, sf_dir), views.REVENUE_BY_MONTH)


@query
def sql_gold_customers(spark, sf_dir):
    return views.over_gold(spark, _gold(spark, sf_dir), views.FIRST_CUSTOMERS)


@query
def sql_gold_trend(spark, sf_dir):
    return views.over_gold(spark, _gold(spark, sf_dir), views.MONTHS_ABOVE_TREND)


@query
def sql_gold_products(spark, sf_dir):
    return views.over_gold(spark, _gold(spark, sf_dir), views.PRODUCTS_BY_CATEGORY)


def _gold(spark, sf_dir):
    return {
        "gold_monthly_region_cat": gold_monthly_region_cat(spark, sf_dir),
        "gold_top_customers": top_customers_region(spark, sf_dir),
        "gold_rev_trend": gold_rev_trend(spark, sf_dir),
        "gold_top_products": gold_top_products(spark, sf_dir),
    }


# Physical modes and layout


def _mode_counts(spark, sf_dir, mode):
    """Rows per region. The frame is read once, so no mode keeps it."""
    star = trade.star(spark, sf_dir)
    dimensions = [
        ("customer_id", clean.pruned_customers(star.customers)),
        ("product_id", clean.pruned_products(star.products)),
    ]
    with modes.joined(mode, star.txns, dimensions, ["region"], keep=False) as frame:
        return reports.count_by_region(frame)


@query
def mode_baseline(spark, sf_dir):
    return _mode_counts(spark, sf_dir, "baseline")


@query
def mode_broadcast(spark, sf_dir):
    return _mode_counts(spark, sf_dir, "broadcast")


@query
def mode_full(spark, sf_dir):
    return _mode_counts(spark, sf_dir, "full")


@query
def mode_full_outputs(spark, sf_dir):
    """Three tables of one kept frame: the joined rows lie in a set number of partitions, spread
    by region, and are computed once. The tables are stored before the frame is released."""
    star = trade.star(spark, sf_dir)
    dimensions = [
        ("customer_id", clean.pruned_customers(star.customers)),
        ("product_id", clean.pruned_products(star.products)),
    ]
    columns = ["region", "category", "quantity", "txn_ts"]
    tasks = _tasks(spark, sf_dir)
    with modes.joined("full", star.txns, dimensions, columns, partitions=tasks) as frame:
        outputs = {
            "rows by region": frame.groupBy(F.col("region").alias("key")),
            "rows by category": frame.groupBy(F.col("category").alias("key")),
            "rows by month": frame.groupBy(month_key("txn_ts").alias("key")),
        }
        stored = []
        for name, groups in outputs.items():
            table = groups.agg(
                F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("units")
            ).select(F.lit(name).alias("output"), "key", "row_count", "units")
            path = fresh_path(spark, "output")
            write_table(table, path, dry_run=False)
            stored.append(tables.read_table(spark, path, table.schema))
    return reduce(DataFrame.unionAll, stored)


@query
def keyed_mode_counts(spark, sf_dir):
    """Rows per region of the text-keyed tables under each mode, side by side."""
    dimensions = [
        ("customer_id", gen_bench_customers(spark, sf_dir).select("customer_id", "region")),
        ("product_id", gen_bench_products(spark, sf_dir).select("product_id")),
    ]
    counts = []
    for mode in modes.MODES:
        with modes.joined(
            mode, gen_bench_txns(spark, sf_dir), dimensions, ["region"], keep=False
        ) as frame:
            counts.append(
                reports.count_by_region(frame).select(F.lit(mode).alias("mode"), "region", "row_count")
            )
    return reduce(DataFrame.unionByName, counts)


_LAID_OUT = ("txn_id", "yyyymm", "region", "quantity")


@query
def repartition_keys(spark, sf_dir):
    rows = _silver(spark, sf_dir).select(*_LAID_OUT)
    n = _tasks(spark, sf_dir)
    return layout.spread_by_keys(rows, n, "yyyymm", "region", spread=n, row_key=["txn_id"])


@query
def repartition_by_key(spark, sf_dir):
    """Grouped by one key, the number of tasks left to adaptive execution."""
    return layout.spread_by_keys(_silver(spark, sf_dir).select(*_LAID_OUT), None, "yyyymm")


@query
def partition_profile(spark, sf_dir):
    """Whether the spread rows lie as evenly as they should."""
    return layout.balance(repartition_keys(spark, sf_dir), _tasks(spark, sf_dir))


# Sinks: written and read back


@query
def sink_parquet_roundtrip(spark, sf_dir):
    rows = trade.transactions(spark, sf_dir)
    path = fresh_path(spark, "txns")
    write_table(rows, path, dry_run=False)
    return tables.read_table(spark, path, rows.schema)


@query
def sink_partitioned_roundtrip(spark, sf_dir):
    stored = _stored_silver(spark, sf_dir).select(*clean.SILVER_COLUMNS)
    return doubles(stored, "base_price", "unit_price", "total_amount")


def _stored_silver(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    path = fresh_path(spark, "silver_orders")
    write_table(rows, path, partition_by=SILVER_FOLDERS, dry_run=False)
    return read_partitioned(spark, path, rows.schema, SILVER_FOLDERS)


@query
def scan_silver_pruned(spark, sf_dir):
    """One month and region of the stored clean sales: only its folder is listed and read."""
    stored = _stored_silver(spark, sf_dir)
    one = stored.where((F.col("yyyymm") == "199701") & (F.col("region") == "ASIA"))
    return doubles(one.select("txn_id", "yyyymm", "region", "quantity", "total_amount"), "total_amount")


@query
def sink_year_month(spark, sf_dir):
    rows = trade.transactions(spark, sf_dir)
    path = fresh_path(spark, "txns_by_month")
    write_by_month(rows, path, dry_run=False)
    return tables.read_table(spark, path)


@query
def sink_csv_roundtrip(spark, sf_dir):
    rows = trade.customers(spark, sf_dir)
    path = fresh_path(spark, "customers_csv")
    write_csv(rows, path, dry_run=False)
    return delimited.read_typed_csv(spark, path, rows.schema)


@query
def sink_file_count(spark, sf_dir):
    path = fresh_path(spark, "txns_in_files")
    write_table(trade.transactions(spark, sf_dir), path, files=_tasks(spark, sf_dir), dry_run=False)
    return (
        tables.read_table(spark, path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("row_count"))
    )


@query
def sink_month_replaced(spark, sf_dir):
    """One month of the stored clean sales is computed anew and put in the place of the old one:
    sales of one region were cancelled, all others got one unit more."""
    rows = _silver(spark, sf_dir)
    path = fresh_path(spark, "silver_orders")
    write_table(rows, path, partition_by=SILVER_FOLDERS, dry_run=False)
    month = read_partitioned(spark, path, rows.schema, SILVER_FOLDERS).where("yyyymm = '199701'")
    corrected = (
        month.where("region IS NULL OR region <> 'ASIA'")
        .withColumn("quantity", F.col("quantity") + 1)
        .withColumn("total_amount", line_amount())
    )
    replace_units(corrected, path, SILVER_FOLDERS, only=[("199701",)])
    stored = read_partitioned(spark, path, rows.schema, SILVER_FOLDERS)
    return doubles(stored.select(*clean.SILVER_COLUMNS), "base_price", "unit_price", "total_amount")


# Late data: a first load, then a batch with new transactions and corrections of old ones

#: When the second batch begins.
LATE = "2001-01-01"


def _loads(spark, sf_dir):
    """The star of the first load and that of the late batch. The batch brings what was sold since
    ``LATE``, and for the largest sales of one channel, of whatever time, copies that are a day
    older and so take the place of those already there."""
    star = trade.star(spark, sf_dir)
    is_late = F.col("txn_ts") >= F.lit(LATE).cast("timestamp_ntz")
    corrected = star.txns.where("quantity = 50 AND channel = 'N'").withColumns(
        {"txn_ts": F.expr("txn_ts - INTERVAL 1 DAY"), "quantity": F.lit(5)}
    )
    first = star.txns.where(~is_late | is_late.isNull())
    late = star.txns.where(is_late).unionByName(corrected)
    return (
        Star(first, star.customers, star.products),
        Star(late, star.customers, star.products),
    )


@query
def silver_upsert(spark, sf_dir):
    """Clean sales after a late batch: the same as one run over all rows."""
    first, late = _loads(spark, sf_dir)
    path = fresh_path(spark, "silver_orders")
    schema = incremental.store_silver(first, path)
    incremental.upsert_silver(late, path)
    stored = incremental.stored_silver(spark, path, schema)
    return doubles(stored, "base_price", "unit_price", "total_amount")


def _maintained(spark, sf_dir, sums):
    """The stored sums after the late batch, kept up to date from its changes."""
    first, late = _loads(spark, sf_dir)
    sales_path, path = fresh_path(spark, "silver_orders"), fresh_path(spark, "sums")
    schema = incremental.store_silver(first, sales_path)
    state = sums.store(incremental.stored_silver(spark, sales_path, schema), path)
    sums.apply(incremental.upsert_silver(late, sales_path), path)
    return sums.read(spark, path, state)


@query
def gold_incremental(spark, sf_dir):
    """Monthly revenue by region and category, maintained."""
    state = _maintained(spark, sf_dir, incremental.REGION_CATEGORY)
    return doubles(
        state.select(
            "yyyymm", "region", "category",
            F.col("total_amount").alias("revenue"), F.col("quantity").alias("units"),
        ),
        "revenue",
    )


@query
def top_customers_incremental(spark, sf_dir):
    """Best customers of each region from maintained sums."""
    sums = incremental.CUSTOMERS
    spend = sums.added_up(_maintained(spark, sf_dir, sums), "region", "customer_id")
    spend = spend.select("region", "customer_id", F.col("total_amount").alias("total_spent"))
    return doubles(gold.top_spenders(spend), "total_spent")


# Storage that makes later reads cheaper


@query
def join_bucketed(spark, sf_dir):
    """Lines and orders stored by buckets of the order key: their join moves no row."""
    lines = trade.table(spark, sf_dir, "lineitem").select(*trade.LINE_COLUMNS)
    orders = trade.table(spark, sf_dir, "orders").select(*trade.ORDER_COLUMNS)
    stored = store_by_key(
        spark,
        [("lines", lines, "l_orderkey"), ("orders", orders, "o_orderkey")],
        _tasks(spark, sf_dir),
    )
    return trade.transactions_of(*[table.frame for table in stored])


@query
def scan_clustered(spark, sf_dir):
    """All transactions of the customer with most of them, from a table along a curve through
    customers, products and days. (Parquet scans do not skip on times without a zone.)"""
    rows = trade.transactions(spark, sf_dir).withColumn("order_date", order_date())
    path = fresh_path(spark, "txns_clustered")
    clustering.write_clustered(
        rows,
        path,
        ("customer_id", "product_id", "order_date"),
        _tasks(spark, sf_dir) * 4,
        row_key=("txn_id",),
    )
    stored = tables.read_table(spark, path, rows.schema)
    busiest = (
        stored.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "customer_id")
        .first()
    )
    if busiest is None:
        return stored
    return stored.where(F.col("customer_id") == busiest.customer_id)


# All grains at once


@query
def revenue_cube(spark, sf_dir):
    return doubles(cubes.revenue_cube(_silver(spark, sf_dir)), "revenue")


@query
def distinct_customers_any_grain(spark, sf_dir):
    """Customers of every grain: counted, and whether stored sketches come within their error."""
    sales = _silver(spark, sf_dir).select(*cubes.KEYS, "customer_id")
    path = fresh_path(spark, "customers_of_groups")
    write_table(sales, path, dry_run=False)
    sales = tables.read_table(spark, path, sales.schema)
    sketch_path = fresh_path(spark, "customer_sketches")
    write_table(cubes.customer_sketches(sales), sketch_path, dry_run=False)
    about = cubes.distinct_customers(tables.read_table(spark, sketch_path))
    exact = cubes.distinct_customers_exact(sales)
    about = about.select(*[F.col(name).alias(f"_{name}") for name in about.columns])
    same = F.lit(True)
    for name in (*cubes.KEYS, cubes.GRAIN):
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    off = F.abs(F.col("_estimate") - F.col("customer_count"))
    return exact.join(about, same).select(
        *cubes.KEYS,
        cubes.GRAIN,
        "customer_count",
        (off <= F.ceil(F.col("customer_count") * cubes.ERROR)).alias("sketch_is_near"),
    )


# Data quality over all rows


#: Types whose values and texts are one to one, so that values may be counted before they are texts.
_ONE_TEXT = (T.StringType, T.IntegralType, T.DateType, T.DecimalType, T.TimestampNTZType)


def _value_counts(rows, name):
    """The rows of each value of a column, as text."""
    text = F.col(name).cast("string")
    early = isinstance(rows.schema[name].dataType, _ONE_TEXT)
    known = rows.where(F.col(name).isNotNull())
    counted = known.groupBy((F.col(name) if early else text).alias("value"))
    return counted.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("of"), F.col("value").cast("string").alias("value"), "rows"
    )


def _near_profile(rows, found):
    """Whether each column's sketches come within their stated errors of what counting gives. Each
    column is counted once: what the sketches claim is looked up while its values are counted."""
    counted = reduce(DataFrame.unionAll, [_value_counts(rows, name) for name in rows.columns])
    claimed = found.select("column_name", F.explode("frequent.value").alias("claim"))
    met = (F.col("of") == F.col("column_name")) & (F.col("value") == F.col("claim"))
    claim = F.when(F.col("claim").isNotNull(), F.struct("value", "rows"))
    whole = (
        counted.join(F.broadcast(claimed), met, "left")
        .groupBy("of")
        .agg(
            F.count(F.lit(1)).alias("distinct"),
            F.sum("rows").alias("n"),
            F.map_from_entries(F.collect_list(claim)).alias("counts"),
        )
    )
    known = found.join(whole, F.col("column_name") == F.col("of"), "left")
    known = known.na.fill(0, ["distinct", "n"])
    slack = F.ceil(F.col("n") * 3.5 / profile.TRACKED)

    def too_far(top):
        return F.abs(top["count"] - F.coalesce(F.col("counts")[top["value"]], F.lit(0))) > slack

    off = F.abs(F.col("distinct_count") - F.col("distinct"))
    return known.select(
        "column_name",
        "row_count",
        "null_count",
        (off <= F.ceil(F.col("distinct") * profile.DISTINCT_ERROR)).alias("distinct_is_near"),
        (~F.coalesce(F.exists("frequent", too_far), F.lit(False))).alias("frequent_is_near"),
    )


@query
def column_profile(spark, sf_dir):
    """Counts of NULLs by column, and whether the sketches of the same pass are as near to exact
    counts as they claim."""
    joined = clean.enriched(trade.star(spark, sf_dir)).drop("total_amount")
    path = fresh_path(spark, "enriched")
    write_table(joined, path, dry_run=False)
    rows = tables.read_table(spark, path, joined.schema)
    profile_path = fresh_path(spark, "profile")
    write_table(profile.column_profile(rows), profile_path, dry_run=False)
    return _near_profile(rows, tables.read_table(spark, profile_path))


@query
def quarantine_txns(spark, sf_dir):
    """Every rule that a transaction breaks, with the number of its rows that do."""
    star = trade.star(spark, sf_dir)
    rules = [
        constraints.within("positive_quantity", "quantity", low=1),
        constraints.Check("known_time", F.col("txn_ts").isNotNull()),
        constraints.one_of("known_channel", "channel", ["A", "N"]),
        constraints.ForeignKey("known_customer", "customer_id", star.customers, "customer_id"),
        constraints.ForeignKey("known_product", "product_id", star.products, "product_id"),
        constraints.Unique("one_row"),
    ]
    return constraints.violations(star.txns, "txn_id", rules)
