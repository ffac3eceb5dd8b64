"""Stored layouts: joins without a shuffle, scans that skip."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyline.operators import clustering
from tallyline.sinks.buckets import is_balanced, store_by_key


def plan_of(frame):
    """The plan that ran."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def sides(spark, hot=0.0, rows=20_000):
    key = F.when(F.col("id") < rows * hot, 7).otherwise(F.col("id") % 997)
    facts = spark.range(rows).select(key.alias("k"), F.col("id").alias("v"))
    other = spark.range(997).select(F.col("id").alias("k2"), (F.col("id") * 2).alias("w"))
    return facts, other


def joined(stored):
    facts, other = (table.frame for table in stored)
    return facts.join(other.hint("merge"), F.col("k") == F.col("k2"))


def test_no_exchange_between_buckets(spark):
    facts, other = sides(spark)
    stored = store_by_key(spark, [("facts", facts, "k"), ("other", other, "k2")], 8)
    assert [table.buckets for table in stored] == [8, 8]
    plan = plan_of(joined(stored))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" not in plan_of(stored[0].frame.groupBy("k").agg(F.sum("v")))
    expected = facts.join(other, F.col("k") == F.col("k2"))
    assert sorted(joined(stored).collect()) == sorted(expected.collect())
    for table in stored:
        files = [f.name for f in Path(table.path.removeprefix("file:")).glob("part-*.parquet")]
        assert len(files) == 8
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_hot_key_gets_no_buckets(spark, set_conf):
    facts, other = sides(spark, hot=0.4)
    assert is_balanced(other, "k2", 8) and not is_balanced(facts, "k", 8, factor=2)
    stored = store_by_key(spark, [("facts", facts, "k"), ("other", other, "k2")], 8, factor=2)
    assert [table.buckets for table in stored] == [0, 0]
    set_conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    facts, _ = (table.frame for table in stored)
    wide = facts.repartition(12).withColumn("pad", F.sha2(F.col("v").cast("string"), 256))
    assert "skew=true" in plan_of(wide.join(stored[1].frame, F.col("k") == F.col("k2")))
    assert joined(stored).count() == 20_000


def test_empty_tables_and_null_keys(spark):
    empty = spark.createDataFrame([], "k long, v long")
    nulls = spark.createDataFrame([(None, 1), (3, 2)], "k2 long, w long")
    stored = store_by_key(spark, [("empty", empty, "k"), ("nulls", nulls, "k2")], 4)
    assert joined(stored).count() == 0
    assert stored[1].frame.count() == 2


def rows_read(frame):
    """Rows that the scan handed on, before the filter."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        children = node.children()
        for position in range(children.size()):
            walk(children.apply(position))

    walk(plan)
    assert found
    return sum(found)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("clustered")
    rows = spark.range(400_000).select(
        F.col("id").alias("txn"),
        (F.xxhash64("id") % 20_000 + 20_000).alias("customer"),
        (F.xxhash64("id", F.lit(1)) % 500 + 500).alias("product"),
        F.expr("date_add(date'2020-01-01', CAST(pmod(xxhash64(id, 2), 2000) AS INT))").alias("at"),
    )
    columns = ("customer", "product", "at")
    # As in large row groups, where dictionaries overflow.
    options = {"parquet.enable.dictionary": "false"}
    clustering.write_clustered(rows, f"{base}/curve", columns, 256, row_key=("txn",), **options)
    rows.repartition(256).write.options(**options).parquet(f"{base}/plain")
    return base, rows


@pytest.mark.parametrize(
    ("condition", "times"), [("customer = 12345", 10), ("product = 321", 3), ("at < '2020-02-01'", 3)]
)
def test_scans_skip_most_rows(spark, tables, condition, times):
    base, rows = tables
    plain, curved = (spark.read.parquet(f"{base}/{name}").where(condition) for name in ("plain", "curve"))
    assert sorted(curved.collect()) == sorted(rows.where(condition).collect())
    assert rows_read(plain) >= 390_000
    assert rows_read(curved) * times <= rows_read(plain)


def test_files_have_bloom_filters_and_even_sizes(tables):
    base, _ = tables
    sizes = []
    for path in sorted(Path(f"{base}/curve").glob("part-*.parquet")):
        meta = pq.ParquetFile(path).metadata
        sizes.append(meta.num_rows)
    assert len(sizes) == 256 and max(sizes) <= 4 * 400_000 / 256


def test_hot_values_nulls_and_texts(spark, tmp_path):
    """A value that half of the rows have, NULLs, and columns of other types."""
    rows = spark.range(6_000).select(
        "id",
        F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("n"),
        F.concat(F.lit("k"), F.col("id") % 10).alias("t"),
        F.expr("date_add(date'2020-01-01', cast(id % 90 as int))").alias("d"),
    )
    clustering.write_clustered(rows, str(tmp_path / "t"), ("n", "t", "d"), 16)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "t").glob("*.parquet")]
    assert max(sizes) <= 4 * 6_000 / 16
    empty = rows.where("id < 0")
    clustering.write_clustered(empty, str(tmp_path / "e"), ("n", "t"), 4)
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "e")).count() == 0
    with pytest.raises(TypeError):
        clustering.quantiles(rows.withColumn("b", F.array("id")), ["b"])


def test_curve_interleaves_ranks(spark):
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    bounds = {name: [float(k) for k in range(1, 8)] for name in ("x", "y")}
    found = {(r.x, r.y): r.z for r in grid.withColumn("z", clustering.curve(grid, bounds, 3)).collect()}
    for (x, y), z in found.items():
        assert z == sum(((x >> b) & 1) << (2 * b) | ((y >> b) & 1) << (2 * b + 1) for b in range(3))
