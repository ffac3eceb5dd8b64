"""The same results in DuckDB SQL, one statement per query."""

from __future__ import annotations

from tallyline.functions.geography import COUNTRIES
from tallyline.generate import keyed, states
from tallyline.generate import star as generated
from tallyline.sources.inference import LATTICE

TXNS = """
txns AS (
  SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS txn_id,
         o_orderdate AS txn_ts,
         CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END AS customer_id,
         CASE WHEN l_tax = 0.08 THEN -1 - l_partkey ELSE l_partkey END AS product_id,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -CAST(l_quantity AS INT)
                   WHEN l_returnflag = 'A' AND l_tax = 0.0 THEN 0
                   ELSE CAST(l_quantity AS INT) END AS INT) AS quantity,
         l_returnflag AS channel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_acctbal >= -500
              THEN CAST(floor((c_acctbal + 1000) / 175) + 18 AS INT) END AS age,
         c_mktsegment AS gender, n_name AS country, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS subcategory,
         p_name AS product_name,
         CASE WHEN p_size = 1 THEN CAST(0 AS DECIMAL(12,2))
              WHEN p_size < 50 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS base_price
  FROM part
)"""

ENRICHED = """
enriched AS (
  SELECT t.*, c.region, c.gender, c.age, p.category, p.subcategory, p.product_name, p.base_price,
         p.base_price AS unit_price,
         CAST(p.base_price * t.quantity AS DECIMAL(18,2)) AS total_amount,
         CAST(t.txn_ts AS DATE) AS order_date,
         strftime(t.txn_ts, '%Y%m') AS yyyymm
  FROM txns t LEFT JOIN customers c USING (customer_id) LEFT JOIN products p USING (product_id)
)"""

DEDUP_ORDER = """
  ORDER BY txn_ts NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,
           quantity NULLS FIRST, channel NULLS FIRST"""

SILVER = f"""
silver AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY txn_id {DEDUP_ORDER}) AS copy
    FROM enriched WHERE quantity > 0 AND unit_price > 0)
  WHERE copy = 1
)"""

STAR = f"WITH {TXNS}, {CUSTOMERS}, {PRODUCTS}"
WITH_ENRICHED = f"{STAR}, {ENRICHED}"
WITH_SILVER = f"{STAR}, {ENRICHED}, {SILVER}"

#: Clean sales over the transactions and the corrections that come with the late batch.
BOTH_LOADS = """
both_loads AS (
  SELECT * FROM txns
  UNION ALL
  SELECT txn_id, txn_ts - INTERVAL 1 DAY, customer_id, product_id, 5, channel
  FROM txns WHERE quantity = 50 AND channel = 'N'
)"""
WITH_BOTH_LOADS = (
    f"{STAR}, {BOTH_LOADS}, {ENRICHED.replace('FROM txns t', 'FROM both_loads t')}, {SILVER}"
)

SILVER_ROWS = """
SELECT txn_id, txn_ts, customer_id, product_id, quantity, channel, region, gender, category,
       subcategory, product_name, CAST(base_price AS DOUBLE) AS base_price,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,
       order_date, yyyymm
FROM silver"""

SPEND = """
spend AS (
  SELECT region, customer_id, SUM(total_amount) AS total_spent
  FROM silver GROUP BY region, customer_id
)"""


def top_customers(function: str, n: int, tie_break: str = "") -> str:
    return f"""{WITH_SILVER}, {SPEND}
    SELECT region, customer_id, CAST(total_spent AS DOUBLE) AS total_spent,
           CAST(place AS INT) AS rank
    FROM (SELECT *, {function}() OVER
            (PARTITION BY region ORDER BY total_spent DESC {tie_break}) AS place FROM spend)
    WHERE place <= {n}"""


MONTHLY = """
monthly AS (SELECT yyyymm, SUM(total_amount) AS revenue FROM silver GROUP BY yyyymm)"""

MOVING = """CAST(round(AVG(revenue) OVER
  (ORDER BY yyyymm ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS DOUBLE)"""

GROWTH = """round(CAST(revenue - lag(revenue) OVER (ORDER BY yyyymm) AS DOUBLE)
  / nullif(CAST(lag(revenue) OVER (ORDER BY yyyymm) AS DOUBLE), 0) * 100, 4)"""

MONTHLY_REGION_CATEGORY = f"""{WITH_SILVER}
SELECT yyyymm, region, category, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(quantity) AS BIGINT) AS units
FROM silver GROUP BY ALL"""

TREND = f"""{WITH_SILVER}, {MONTHLY}
SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue, {MOVING} AS rev_ma_3m FROM monthly"""

TOP_PRODUCTS = f"""{WITH_SILVER}
SELECT product_id, product_name, category, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(quantity) AS BIGINT) AS units
FROM silver GROUP BY product_id, product_name, category
ORDER BY SUM(total_amount) DESC, product_id LIMIT 50"""

CATEGORY_SHARE = f"""{WITH_SILVER}, by_category AS (
  SELECT category, SUM(total_amount) AS revenue FROM silver GROUP BY category)
SELECT category, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / nullif(CAST(SUM(revenue) OVER () AS DOUBLE), 0), 6) AS share
FROM by_category"""

JOINED = """SELECT t.txn_id, t.customer_id, t.product_id, t.quantity, c.region, p.category,
       CAST(p.base_price AS DOUBLE) AS base_price"""

INNER = f"{STAR} {JOINED} FROM txns t JOIN customers c USING (customer_id) " + (
    "JOIN products p USING (product_id)"
)

COUNT_INNER = f"""{STAR} SELECT c.region, COUNT(*) AS row_count
FROM txns t JOIN customers c USING (customer_id) JOIN products p USING (product_id)
GROUP BY c.region"""

CLEANED = """SELECT txn_id, customer_id, product_id, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount
FROM enriched WHERE quantity > 0 AND unit_price > 0"""

STATE_SALES = """
sales AS (
  SELECT o_orderkey AS id, c_name AS name, n_name AS state,
         CAST(o_totalprice AS DECIMAL(12,2)) AS sales
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), pairs AS (
  SELECT DISTINCT n_name AS state, CAST(floor((s_acctbal + 1000) / 2200) + 1 AS BIGINT) AS category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

FAN_OUT = f"""WITH {STATE_SALES}
SELECT id, name, state, CAST(sales AS DOUBLE) AS sales, category
FROM sales JOIN pairs USING (state)"""

PROFILED = (
    "txn_id", "txn_ts", "customer_id", "product_id", "quantity", "channel", "region", "gender",
    "category", "subcategory", "product_name", "base_price", "unit_price", "total_amount",
    "order_date", "yyyymm",
)

NULL_PROFILE = f"{WITH_ENRICHED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, COUNT(*) - COUNT({name}) AS null_count, "
    f"COUNT(*) AS row_count FROM enriched"
    for name in PROFILED
)

CAPITALISED = (
    "array_to_string(list_transform(string_split(lower({0}), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)

TXN_COLUMNS = "txn_id, txn_ts, customer_id, product_id, quantity, channel"


# Synthetic rows, from the same digests


def sha(table: str, row_id: str) -> str:
    return f"sha256('42|{table}|' || ({row_id}))"


def number(start: int, digits: int) -> str:
    return f"CAST('0x' || substr(d, {start}, {digits}) AS BIGINT)"


def below(start: int, digits: int, bound: int | str) -> str:
    return f"({number(start, digits)} % {bound})"


def array(values) -> str:
    return "[" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + "]"


def pick(start: int, digits: int, values) -> str:
    return f"({array(values)})[{below(start, digits, len(values))} + 1]"


def key_text(table: str, row_id: str) -> str:
    hexed = f"md5('42|{table}|' || ({row_id}))"
    return (
        f"regexp_replace({hexed}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
        r"'\1-\2-\3-\4-\5')"
    )


PERSON = (
    f"{pick(1, 8, generated.FIRST_NAMES)} || ' ' || {pick(9, 8, generated.LAST_NAMES)}"
)
REGION_OF = """CASE
  WHEN country IN ('United States', 'Canada', 'Mexico') THEN 'North America'
  WHEN country IN ('United Kingdom', 'France', 'Germany', 'Italy', 'Spain') THEN 'Europe'
  WHEN country IN ('India', 'China', 'Japan', 'Singapore') THEN 'Asia'
  ELSE 'Other' END"""
N_CUSTOMERS = "(SELECT COUNT(*) FROM customer)"
N_PRODUCTS = "(SELECT COUNT(*) FROM part)"
SUBCATEGORY = (
    "(CASE category "
    + " ".join(
        f"WHEN '{category}' THEN {array(names)}"
        for category, names in generated.SUBCATEGORIES.items()
    )
    + f" END)[{below(9, 8, 5)} + 1]"
)

GEN_CUSTOMERS = f"""
SELECT CAST(id AS INT) AS customer_id, {PERSON} AS customer_name,
       CAST({below(17, 8, 63)} + 18 AS INT) AS age, {pick(25, 8, generated.GENDERS)} AS gender,
       country, {REGION_OF} AS region
FROM (SELECT *, {pick(33, 8, COUNTRIES)} AS country
      FROM (SELECT c_custkey + 1 AS id, {sha('customer', 'c_custkey + 1')} AS d FROM customer))"""

GEN_PRODUCTS = f"""
SELECT product_id, category, subcategory,
       category || '-' || subcategory || '-' || printf('%05d', product_id) AS product_name,
       base_price
FROM (SELECT CAST(id AS INT) AS product_id, category, {SUBCATEGORY} AS subcategory,
             ({below(17, 15, 149501)} + 500) / 100 AS base_price
      FROM (SELECT *, {pick(1, 8, tuple(generated.SUBCATEGORIES))} AS category
            FROM (SELECT p_partkey + 1 AS id, {sha('product', 'p_partkey + 1')} AS d FROM part)))"""

GEN_TXNS = f"""
SELECT printf('TXN-%010d', id) AS txn_id,
       TIMESTAMP '2025-08-31' - to_days(CAST({below(31, 8, 271)} AS INT))
         + to_seconds({below(39, 8, 86400)}) AS txn_ts,
       CAST({below(1, 15, N_CUSTOMERS)} + 1 AS INT) AS customer_id,
       CAST({below(16, 15, N_PRODUCTS)} + 1 AS INT) AS product_id,
       CAST({below(47, 8, 5)} + 1 AS INT) AS quantity,
       {pick(55, 8, generated.CHANNELS)} AS channel
FROM (SELECT o_orderkey + 1 AS id, {sha('transaction', 'o_orderkey + 1')} AS d FROM orders)"""

GEN_BENCH_CUSTOMERS = f"""
SELECT {key_text('keyed customer', 'id')} AS customer_id, {PERSON} AS name,
       {pick(17, 8, keyed.CITIES)} AS city, {pick(25, 8, keyed.REGIONS)} AS region
FROM (SELECT c_custkey + 1 AS id, {sha('keyed customer', 'c_custkey + 1')} AS d FROM customer)"""

GEN_BENCH_PRODUCTS = f"""
SELECT key AS product_id, upper(word[1]) || word[2:] AS name, category, price
FROM (SELECT {key_text('keyed product', 'id')} AS key, {pick(1, 8, keyed.WORDS)} AS word,
             {pick(9, 8, keyed.CATEGORIES)} AS category,
             ({below(17, 15, 14001)} + 1000) / 100 AS price
      FROM (SELECT p_partkey + 1 AS id, {sha('keyed product', 'p_partkey + 1')} AS d FROM part))"""

GEN_BENCH_TXNS = f"""
SELECT {key_text('keyed transaction', 'id')} AS transaction_id,
       {key_text('keyed customer', below(1, 15, N_CUSTOMERS) + ' + 1')} AS customer_id,
       {key_text('keyed product', below(16, 15, N_PRODUCTS) + ' + 1')} AS product_id,
       CAST({below(47, 8, 5)} + 1 AS INT) AS quantity,
       strftime(DATE '2024-01-01' + CAST({below(31, 8, 608)} AS INT), '%Y-%m-%d')
         AS transaction_date
FROM (SELECT o_orderkey + 1 AS id, {sha('keyed transaction', 'o_orderkey + 1')} AS d FROM orders)"""

GEN_STATE_SALES = f"""
SELECT id, {PERSON} AS name, {pick(17, 8, states.STATES)} AS state,
       {below(25, 8, 901)} + 100 AS sales
FROM (SELECT o_orderkey + 1 AS id, {sha('state sale', 'o_orderkey + 1')} AS d FROM orders)"""


#: The columns of ``enriched`` that are profiled.
_PROFILED = (
    "txn_id", "txn_ts", "customer_id", "product_id", "quantity", "channel", "region", "gender",
    "category", "subcategory", "product_name", "base_price", "unit_price", "order_date", "yyyymm",
)

#: For every type of the lattice its place and how many values fit it.
_FITTING = [
    f"{{'place': {place}, 'n': count(*) FILTER (regexp_matches(value, '{pattern}')"
    f" AND TRY_CAST(value AS {kind.simpleString().removesuffix('_ntz')}) IS NOT NULL)}}"
    for place, (kind, pattern) in enumerate(LATTICE)
]

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "scan_guarded": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "scan_csv_typed": f"""WITH {TXNS}
        SELECT txn_id, txn_ts, customer_id, product_id,
               CASE WHEN channel <> 'N' THEN quantity END AS quantity, channel,
               channel = 'N' AS is_bad
        FROM txns""",
    "gen_ids": """SELECT o_orderkey + 1 AS id, printf('TXN-%010d', o_orderkey + 1) AS txn_key
        FROM orders""",
    "gen_customers": GEN_CUSTOMERS,
    "gen_products": GEN_PRODUCTS,
    "gen_txns": GEN_TXNS,
    "gen_bench_customers": GEN_BENCH_CUSTOMERS,
    "gen_bench_products": GEN_BENCH_PRODUCTS,
    "gen_bench_txns": GEN_BENCH_TXNS,
    "gen_bench_tables": f"""
        SELECT t.product_id, t.customer_id, t.transaction_id, t.quantity, t.transaction_date,
               c.name AS customer_name, c.city, c.region,
               p.name AS product_name, p.category, p.price
        FROM ({GEN_BENCH_TXNS}) t JOIN ({GEN_BENCH_CUSTOMERS}) c USING (customer_id)
             JOIN ({GEN_BENCH_PRODUCTS}) p USING (product_id)""",
    "gen_state_sales": GEN_STATE_SALES,
    "gen_state_category_sum": f"""
        SELECT category, CAST(SUM(sales) AS BIGINT) AS sales
        FROM ({GEN_STATE_SALES}) s
             JOIN (SELECT {pick(1, 8, states.STATES)} AS state, {below(9, 8, 5)} + 1 AS category
                   FROM (SELECT {sha('state category', 'id')} AS d
                         FROM (SELECT unnest(range(1, {states.CATEGORY_ROWS} + 1)) AS id))) c
             USING (state)
        GROUP BY category""",
    "project_prune": f"WITH {CUSTOMERS} SELECT customer_id, region, gender FROM customers",
    "derive_line_amount": f"""{WITH_ENRICHED}
        SELECT txn_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(total_amount AS DOUBLE) AS total_amount
        FROM enriched""",
    "coalesce_price": f"""{WITH_ENRICHED}
        SELECT txn_id, product_id, CAST(coalesce(base_price, 0) AS DOUBLE) AS unit_price
        FROM enriched""",
    "derive_dates": f"""WITH {TXNS}
        SELECT txn_id, txn_ts, CAST(txn_ts AS DATE) AS order_date,
               strftime(txn_ts, '%Y%m') AS yyyymm,
               CAST(year(txn_ts) AS INT) AS year, CAST(month(txn_ts) AS INT) AS month
        FROM txns""",
    "map_region": f"""SELECT customer_id, country, {REGION_OF} AS region
        FROM (SELECT c_custkey AS customer_id, ({array(COUNTRIES)})[c_nationkey + 1] AS country
              FROM customer)""",
    "scalar_suite": f"""
        SELECT o_orderkey AS id, printf('TXN-%010d', o_orderkey) AS padded_ten,
               printf('%05d', o_custkey) AS padded_five, round(o_totalprice / 3, 2) AS rounded,
               {below(1, 8, 6)} AS drawn, {key_text('order', 'o_orderkey')} AS key_text,
               CAST(o_orderdate AS DATE) - 30 AS month_before,
               o_orderdate + to_seconds({below(9, 8, 86400)}) AS at_second,
               strftime(o_orderdate, '%Y-%m-%d') AS day_text,
               CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS day_parsed,
               {CAPITALISED.format('substr(o_orderpriority, 3)')} AS capitalised,
               o_orderstatus IN ('O', 'F') AS is_settled,
               CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled'
                                  WHEN 'P' THEN 'Partial' END AS status_name,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS cast_int,
               TRY_CAST(o_orderpriority AS INT) AS cast_failed
        FROM (SELECT *, {sha('order', 'o_orderkey')} AS d FROM orders)""",
    "clean_filter": f"{WITH_ENRICHED} {CLEANED}",
    "clean_filter_zero_price": f"{WITH_ENRICHED} {CLEANED}",
    "clean_nulls": f"""{WITH_ENRICHED}
        SELECT txn_id, product_id, coalesce(region, 'Unknown') AS region,
               coalesce(gender, 'Unknown') AS gender, coalesce(category, 'Unknown') AS category,
               CAST(base_price AS DOUBLE) AS base_price
        FROM enriched""",
    "null_profile": NULL_PROFILE,
    "clean_text": f"""SELECT p_partkey AS product_id, {CAPITALISED.format('p_name')} AS product_name
        FROM part""",
    "dedup_txn": f"""WITH {TXNS}
        SELECT {TXN_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY txn_id {DEDUP_ORDER}) AS copy FROM txns)
        WHERE copy = 1""",
    "silver_orders": f"{WITH_SILVER} {SILVER_ROWS}",
    "join_left_broadcast": f"""{STAR} {JOINED}
        FROM txns t LEFT JOIN customers c USING (customer_id)
             LEFT JOIN products p USING (product_id)""",
    "join_inner_shuffle": INNER,
    "join_inner_broadcast": INNER,
    "join_fanout": FAN_OUT,
    "join_fanout_broadcast": FAN_OUT,
    "sum_by_category": f"""WITH {STATE_SALES}
        SELECT category, CAST(SUM(sales) AS DOUBLE) AS sales
        FROM sales JOIN pairs USING (state) GROUP BY category""",
    "gold_monthly_region_cat": MONTHLY_REGION_CATEGORY,
    "top_customers_region": top_customers("dense_rank", 10),
    "top5_customers_region": top_customers("dense_rank", 5),
    "top_customers_rank": top_customers("rank", 10),
    "top_customers_row_number": top_customers("row_number", 10, ", customer_id"),
    "gold_rev_trend": TREND,
    "rev_trend_calendar": f"""{WITH_SILVER}, {MONTHLY}
        SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue,
               CAST(round(AVG(revenue) OVER (
                   ORDER BY CAST(yyyymm AS INT) // 100 * 12 + CAST(yyyymm AS INT) % 100
                   RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS DOUBLE) AS rev_ma_3m
        FROM monthly""",
    "gold_top_products": TOP_PRODUCTS,
    "customer_spend": f"""{WITH_SILVER}, {SPEND}
        SELECT region, customer_id, CAST(total_spent AS DOUBLE) AS total_spent FROM spend""",
    "monthly_total": f"""{WITH_SILVER}, {MONTHLY}
        SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue FROM monthly""",
    "silver_count": f"{WITH_SILVER} SELECT COUNT(*) AS row_count FROM silver",
    "category_share": CATEGORY_SHARE,
    "mom_growth": f"""{WITH_SILVER}, {MONTHLY}
        SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue, {GROWTH} AS growth_pct FROM monthly""",
    "sales_by_age_group": f"""{WITH_SILVER}
        SELECT CASE WHEN age IS NULL THEN 'unknown' WHEN age < 18 THEN '<18'
                    WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34'
                    WHEN age <= 44 THEN '35-44' WHEN age <= 54 THEN '45-54'
                    WHEN age <= 64 THEN '55-64' ELSE '65+' END AS age_group,
               CAST(SUM(total_amount) AS DOUBLE) AS revenue,
               COUNT(DISTINCT customer_id) AS customers
        FROM silver GROUP BY age_group""",
    "count_by_region": f"""{WITH_SILVER}
        SELECT region, COUNT(*) AS row_count FROM silver GROUP BY region""",
    "region_revenue": f"""{WITH_SILVER}
        SELECT region, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
               CAST(SUM(quantity) AS BIGINT) AS units
        FROM silver GROUP BY region""",
    "region_category_kpis": f"""{WITH_SILVER}
        SELECT region, category, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
               CAST(SUM(quantity) AS BIGINT) AS units, COUNT(txn_id) AS orders,
               round(CAST(SUM(total_amount) AS DOUBLE) / COUNT(txn_id), 4) AS avg_order_value
        FROM silver GROUP BY region, category""",
    "report_silver_sample": f"""{WITH_SILVER}
        SELECT txn_id, order_date, region, category, quantity,
               CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(total_amount AS DOUBLE) AS total_amount, yyyymm
        FROM silver ORDER BY txn_id LIMIT 5""",
    "report_region": f"""{WITH_SILVER}, {SPEND}, by_region AS (
          SELECT region, SUM(total_amount) AS region_revenue FROM silver GROUP BY region)
        SELECT s.region, CAST(r.region_revenue AS DOUBLE) AS region_revenue,
               CAST(s.place AS INT) AS rank, s.customer_id,
               CAST(s.total_spent AS DOUBLE) AS total_spent
        FROM (SELECT *, dense_rank() OVER
                (PARTITION BY region ORDER BY total_spent DESC) AS place FROM spend) s
             JOIN by_region r ON s.region IS NOT DISTINCT FROM r.region
        WHERE s.place <= 5""",
    "report_monthly": f"""{WITH_SILVER}, {MONTHLY}
        SELECT yyyymm, CAST(revenue AS DOUBLE) AS revenue, {MOVING} AS rev_ma_3m,
               {GROWTH} AS growth_pct
        FROM monthly""",
    "report_category": CATEGORY_SHARE,
    "report_head_monthly": f"""{MONTHLY_REGION_CATEGORY}
        ORDER BY yyyymm, region NULLS FIRST, category LIMIT 8""",
    "report_head_top_customers": top_customers("dense_rank", 10)
    + " ORDER BY region NULLS FIRST, rank, customer_id LIMIT 8",
    "report_head_trend": f"{TREND} ORDER BY yyyymm LIMIT 8",
    "report_head_top_products": f"""SELECT * FROM ({TOP_PRODUCTS})
        ORDER BY revenue DESC, product_id LIMIT 8""",
    "sql_view_monthly": MONTHLY_REGION_CATEGORY,
    "sql_view_top_customers": top_customers("dense_rank", 10),
    "sql_view_trend": TREND,
    "sql_view_top_products": TOP_PRODUCTS,
    "sql_gold_monthly": f"""SELECT yyyymm, round(SUM(revenue), 2) AS revenue,
               CAST(SUM(units) AS BIGINT) AS units
        FROM ({MONTHLY_REGION_CATEGORY}) GROUP BY yyyymm""",
    "sql_gold_customers": f"""SELECT region, customer_id, total_spent
        FROM ({top_customers("dense_rank", 10)}) WHERE rank = 1""",
    "sql_gold_trend": f"""SELECT * FROM ({TREND}) WHERE revenue > rev_ma_3m""",
    "sql_gold_products": f"""SELECT category, COUNT(*) AS products,
               CAST(SUM(units) AS BIGINT) AS units
        FROM ({TOP_PRODUCTS}) GROUP BY category""",
    "mode_baseline": COUNT_INNER,
    "mode_broadcast": COUNT_INNER,
    "mode_full": COUNT_INNER,
    "repartition_keys": f"{WITH_SILVER} SELECT txn_id, yyyymm, region, quantity FROM silver",
    "repartition_by_key": f"{WITH_SILVER} SELECT txn_id, yyyymm, region, quantity FROM silver",
    "partition_profile": f"""{WITH_SILVER}
        SELECT COUNT(*) AS row_count, true AS within_count, true AS is_balanced FROM silver""",
    "keyed_mode_counts": f"""
        WITH counts AS (
            SELECT c.region, COUNT(*) AS row_count
            FROM ({GEN_BENCH_TXNS}) t JOIN ({GEN_BENCH_CUSTOMERS}) c USING (customer_id)
                 JOIN ({GEN_BENCH_PRODUCTS}) p USING (product_id)
            GROUP BY c.region)
        SELECT mode, region, row_count
        FROM counts, (VALUES ('baseline'), ('broadcast'), ('full')) AS modes(mode)""",
    "scan_silver_pruned": f"""{WITH_SILVER}
        SELECT txn_id, yyyymm, region, quantity, CAST(total_amount AS DOUBLE) AS total_amount
        FROM silver WHERE yyyymm = '199701' AND region = 'ASIA'""",
    "sink_parquet_roundtrip": f"WITH {TXNS} SELECT {TXN_COLUMNS} FROM txns",
    "sink_partitioned_roundtrip": f"{WITH_SILVER} {SILVER_ROWS}",
    "sink_year_month": f"""WITH {TXNS}
        SELECT {TXN_COLUMNS}, CAST(year(txn_ts) AS INT) AS year,
               CAST(month(txn_ts) AS INT) AS month
        FROM txns""",
    "sink_csv_roundtrip": f"""WITH {CUSTOMERS}
        SELECT customer_id, customer_name, age, gender, country, region, false AS is_bad
        FROM customers""",
    "sink_file_count": f"""WITH {TXNS}
        SELECT CAST(greatest(16, ceil(COUNT(*) / 1000000)) AS BIGINT) AS files,
               COUNT(*) AS row_count FROM txns""",
    "sink_month_replaced": f"""{WITH_SILVER}, corrected AS (
        SELECT * FROM silver WHERE yyyymm IS DISTINCT FROM '199701'
        UNION ALL
        SELECT * REPLACE (quantity + 1 AS quantity,
            CAST(unit_price * (quantity + 1) AS DECIMAL(18,2)) AS total_amount)
        FROM silver WHERE yyyymm = '199701' AND region IS DISTINCT FROM 'ASIA')
        {SILVER_ROWS.replace("FROM silver", "FROM corrected")}""",
    "silver_upsert": f"{WITH_BOTH_LOADS} {SILVER_ROWS}",
    "gold_incremental": MONTHLY_REGION_CATEGORY.replace(WITH_SILVER, WITH_BOTH_LOADS),
    "top_customers_incremental": top_customers("dense_rank", 10).replace(
        WITH_SILVER, WITH_BOTH_LOADS
    ),
    "join_bucketed": f"WITH {TXNS} SELECT {TXN_COLUMNS} FROM txns",
    "scan_clustered": f"""WITH {TXNS}
        SELECT {TXN_COLUMNS}, CAST(txn_ts AS DATE) AS order_date FROM txns WHERE customer_id = (
            SELECT customer_id FROM txns GROUP BY customer_id
            ORDER BY count(*) DESC, customer_id LIMIT 1)""",
    "scan_csv_inferred": f"""WITH {TXNS}, raw AS (
          SELECT txn_id, CAST(txn_ts AS VARCHAR) AS txn_ts, CAST(customer_id AS VARCHAR) AS customer_id,
                 CAST(product_id AS VARCHAR) AS product_id,
                 CAST(quantity AS VARCHAR) || CASE WHEN channel = 'N' THEN 'x' ELSE '' END AS quantity,
                 channel
          FROM txns
        ), long AS (UNPIVOT raw ON COLUMNS(*) INTO NAME column_name VALUE value
        ), fits AS (
          SELECT column_name, count(*) AS value_count, unnest([{", ".join(_FITTING)}]) AS fit
          FROM long GROUP BY column_name
        ), best AS (
          SELECT column_name, value_count, max(fit.n) AS n, min(fit.place) AS place FROM fits
          WHERE fit.n = (SELECT max(f.fit.n) FROM fits f WHERE f.column_name = fits.column_name)
          GROUP BY column_name, value_count)
        SELECT column_name, value_count,
               CASE WHEN value_count - n <= 0.5 * value_count
                    THEN list_value({", ".join(f"'{kind.simpleString()}'" for kind, _ in LATTICE)})[place + 1]
                    ELSE 'string' END AS type,
               CAST(CASE WHEN value_count - n <= 0.5 * value_count
                         THEN value_count - n ELSE 0 END AS BIGINT) AS misfits
        FROM best""",
    "revenue_cube": f"""{WITH_SILVER}
        SELECT yyyymm, region, category, CAST(GROUPING_ID(yyyymm, region, category) AS INT) AS grain,
               CAST(SUM(total_amount) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units,
               COUNT(*) AS row_count
        FROM silver GROUP BY CUBE (yyyymm, region, category)""",
    "distinct_customers_any_grain": f"""{WITH_SILVER}
        SELECT yyyymm, region, category, CAST(GROUPING_ID(yyyymm, region, category) AS INT) AS grain,
               COUNT(DISTINCT customer_id) AS customer_count, true AS sketch_is_near
        FROM silver GROUP BY CUBE (yyyymm, region, category)""",
    "column_profile": f"""{WITH_ENRICHED}
        {" UNION ALL ".join(
            f"SELECT '{name}' AS column_name, COUNT(*) AS row_count,"
            f" COUNT(*) - COUNT({name}) AS null_count, true AS distinct_is_near,"
            " true AS frequent_is_near FROM enriched" for name in _PROFILED)}""",
    "quarantine_txns": f"""{STAR}, broken AS (
        SELECT txn_id, unnest([
            CASE WHEN quantity >= 1 THEN NULL ELSE 'positive_quantity' END,
            CASE WHEN txn_ts IS NOT NULL THEN NULL ELSE 'known_time' END,
            CASE WHEN channel IN ('A', 'N') THEN NULL ELSE 'known_channel' END,
            CASE WHEN customer_id IN (SELECT customer_id FROM customers) THEN NULL
                 ELSE 'known_customer' END,
            CASE WHEN product_id IN (SELECT product_id FROM products) THEN NULL
                 ELSE 'known_product' END]) AS rule
        FROM txns)
        SELECT txn_id, rule, COUNT(*) AS row_count FROM broken WHERE rule IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT txn_id, 'one_row', COUNT(*) FROM txns GROUP BY txn_id HAVING COUNT(*) > 1""",
}
ORACLE["mode_full_outputs"] = f"""{STAR}, joined AS (
    SELECT c.region, p.category, t.quantity, strftime(t.txn_ts, '%Y%m') AS month
    FROM txns t JOIN customers c USING (customer_id) JOIN products p USING (product_id))
    {" UNION ALL ".join(
        f"SELECT 'rows by {name}' AS output, {name} AS key, COUNT(*) AS row_count,"
        f" CAST(SUM(quantity) AS BIGINT) AS units FROM joined GROUP BY {name}"
        for name in ("region", "category", "month"))}"""
ORACLE["scan_csv_inferred_rows"] = f"""SELECT * REPLACE (CAST(customer_id AS INT) AS customer_id,
    CAST(product_id AS INT) AS product_id) FROM ({ORACLE["scan_csv_typed"]})"""
