"""Every query against DuckDB over the same files, row for row."""

import os
from pathlib import Path

import duckdb
import pytest

from tallyline.catalog import QUERIES
from tallyline.operators.layout import partition_profile
from tallyline.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
NOT_IN_SQL: set[str] = set()

#: Output order, which a comparison of sorted rows cannot see.
ORDERS = {
    "gold_monthly_region_cat": lambda r: (r.yyyymm, r.region is not None, r.region, r.category),
    "sql_view_monthly": lambda r: (r.yyyymm, r.region is not None, r.region, r.category),
    "top_customers_region": lambda r: (r.region is not None, r.region, r.rank, r.customer_id),
    "top5_customers_region": lambda r: (r.region is not None, r.region, r.rank, r.customer_id),
    "top_customers_rank": lambda r: (r.region is not None, r.region, r.rank, r.customer_id),
    "top_customers_row_number": lambda r: (r.region is not None, r.region, r.rank),
    "sql_view_top_customers": lambda r: (r.region is not None, r.region, r.rank, r.customer_id),
    "report_region": lambda r: (r.region is not None, r.region, r.rank, r.customer_id),
    "gold_rev_trend": lambda r: r.yyyymm,
    "sql_view_trend": lambda r: r.yyyymm,
    "report_monthly": lambda r: r.yyyymm,
    "gold_top_products": lambda r: (-r.revenue, r.product_id),
    "sql_view_top_products": lambda r: (-r.revenue, r.product_id),
    "report_category": lambda r: (-r.share, r.category),
    "report_silver_sample": lambda r: r.txn_id,
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def text(value):
    return f"{value:.6f}" if isinstance(value, float) else repr(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLE) == NOT_IN_SQL
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = found.collect()
    answer = duck.execute(ORACLE[name])
    described = {column[0]: str(column[1]) for column in answer.description}
    assert sorted(described) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in found.schema} == described
    expected = answer.fetchall()
    position = [list(described).index(column) for column in columns]
    assert sorted([text(row[c]) for c in columns] for row in rows) == sorted(
        [text(row[p]) for p in position] for row in expected
    )
    if name in ORDERS:
        assert [tuple(r) for r in rows] == [
            tuple(r) for r in sorted(rows, key=lambda r: _nulls_low(ORDERS[name](r)))
        ]


def _nulls_low(key):
    return tuple("" if part is None else part for part in key) if isinstance(key, tuple) else key


def test_partitions_hold_all_rows(spark):
    profile = partition_profile(QUERIES["repartition_keys"](spark, SF_DIR)).collect()
    assert sum(row.row_count for row in profile) == QUERIES["silver_count"](
        spark, SF_DIR
    ).first().row_count
    assert 1 < len(profile) <= 16


def test_totals_agree(spark):
    def total(name):
        return sum(row.revenue for row in QUERIES[name](spark, SF_DIR).collect())

    expected = total("monthly_total")
    assert total("gold_monthly_region_cat") == pytest.approx(expected, abs=0.01)
    assert total("region_revenue") == pytest.approx(expected, abs=0.01)
    assert total("category_share") == pytest.approx(expected, abs=0.01)


def test_shares_sum_to_one(spark):
    shares = [row.share for row in QUERIES["category_share"](spark, SF_DIR).collect()]
    assert sum(shares) == pytest.approx(1, abs=1e-5)
