from datetime import datetime
from pathlib import Path

import pytest
from frames import TXNS, star, txn
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.plans.silver import silver
from tallyline.sinks import scratch
from tallyline.sinks.tables import (
    FormatUnavailable,
    read_partitioned,
    write_by_month,
    write_csv,
    write_table,
)
from tallyline.sources import delimited, tables


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_every_missing_table_is_named(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "txns"))
    with pytest.raises(tables.MissingTables) as caught:
        tables.read_star(spark, str(tmp_path))
    assert [Path(p).name for p in caught.value.paths] == ["dim_customers", "dim_products"]


def test_guard_does_not_hide_other_errors(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.read_if_present(spark, str(tmp_path / "broken.parquet")).collect()
    assert tables.read_if_present(spark, str(tmp_path / "none")) is None


def test_dimension_keys_must_be_unique(spark):
    tables.require_unique_key(spark.range(5), "id")
    with pytest.raises(tables.RepeatedKeys, match="1 repeated"):
        tables.require_unique_key(spark.createDataFrame([(1,), (1,), (2,)], "id int"), "id")
    with pytest.raises(tables.RepeatedKeys, match="1 NULL"):
        tables.require_unique_key(spark.createDataFrame([(1,), (None,)], "id int"), "id")


def test_dry_run_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not write_table(spark.range(3), path).done
    assert not write_csv(spark.range(3), path).done
    assert not write_by_month(spark.createDataFrame([], TXNS), path).done
    assert not Path(path).exists()


def test_overwrite_twice_is_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert write_table(spark.range(50), path, dry_run=False).done
    assert spark.read.parquet(path).count() == 50


def test_partitions_keep_nulls_and_text_months(spark, tmp_path):
    frame = silver(star(spark, [txn("a", 1, 1, 1), txn("b", 99, 1, 2), txn("c", 2, 2, 3)]))
    path = str(tmp_path / "silver")
    write_table(frame, path, partition_by=("yyyymm", "region"), dry_run=False)
    back = tables.read_table(spark, path, frame.schema).select(*frame.columns)
    assert dict(back.dtypes)["yyyymm"] == "string"
    assert rows(back) == rows(frame)
    assert (tmp_path / "silver/yyyymm=202501/region=__HIVE_DEFAULT_PARTITION__").is_dir()
    pruned = back.filter("yyyymm = '202501' and region = 'South'")
    assert pruned.count() == 1
    pruned_files = [p for p in pruned.inputFiles()]
    assert len(pruned_files) >= 1


def test_a_large_folder_gets_several_writers(spark, tmp_path, set_conf):
    set_conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    frame = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"),
    )
    path = tmp_path / "t"
    write_table(frame, str(path), partition_by=("k",), dry_run=False)
    assert len(list((path / "k=hot").glob("part-*"))) > 3
    assert spark.read.parquet(str(path)).count() == 200_000


def test_year_month_folders(spark, tmp_path):
    frame = spark.createDataFrame(
        [txn("a", 1, 1, 1, ts="2024-12-31 23:59:59"), txn("b", 1, 1, 1, ts=None)], TXNS
    )
    path = tmp_path / "t"
    write_by_month(frame, str(path), dry_run=False)
    assert (path / "year=2024/month=12").is_dir()
    back = spark.read.parquet(str(path))
    assert {(r.txn_id, r.year, r.month) for r in back.collect()} == {
        ("a", 2024, 12),
        ("b", None, None),
    }


def test_ungrouped_partitioned_write(spark, tmp_path):
    frame = spark.range(0, 100, 1, 4).withColumn("k", F.col("id") % 3)
    path = str(tmp_path / "t")
    write_table(frame, path, partition_by=("k",), grouped=False, dry_run=False)
    assert rows(spark.read.parquet(path).select("id", F.col("k").cast("bigint"))) == rows(frame)
    assert len(list(Path(path, "k=0").glob("part-*"))) == 4


def test_file_count(spark, tmp_path):
    write_table(spark.range(1000), str(tmp_path / "t"), files=5, dry_run=False)
    assert len(list((tmp_path / "t").glob("part-*"))) == 5


def test_unknown_format_says_so(spark, tmp_path):
    with pytest.raises(FormatUnavailable, match="delta"):
        write_table(spark.range(1), str(tmp_path / "t"), fmt="delta", dry_run=False)


def test_csv_keeps_spaces_quotes_commas_nulls_and_empty_text(spark, tmp_path):
    values = ['  two  spaces ', 'say "hi", you', "back\\slash", "", None, "plain"]
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    path = str(tmp_path / "c")
    write_csv(frame, path, dry_run=False)
    back = delimited.read_typed_csv(spark, path, frame.schema)
    assert {(r.n, r.v) for r in back.collect()} == set(enumerate(values))
    assert back.filter("is_bad").count() == 0


def test_malformed_csv_does_not_fail(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "txn_id,txn_ts,quantity,price\n"
        "a,2025-01-01 10:00:00,2,1.50\n"
        "b,2025-01-01 10:00:00,two,1.50\n"
        "c,yesterday,2,1.50\n"
        "d,2025-01-01 10:00:00,2\n"
        "e,,,\n"
    )
    schema = T.StructType(
        [
            T.StructField("txn_id", T.StringType()),
            T.StructField("txn_ts", T.TimestampNTZType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("price", T.DecimalType(12, 2)),
        ]
    )
    read = delimited.read_typed_csv(spark, str(tmp_path / "f.csv"), schema)
    found = {r.txn_id: r for r in read.collect()}
    assert [found[k].is_bad for k in "abcde"] == [False, True, True, True, False]
    assert found["b"].quantity is None and found["c"].txn_ts is None
    assert found["a"].txn_ts == datetime(2025, 1, 1, 10)


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,x\n2,y\n")
    assert delimited.inferred_csv(spark, str(tmp_path / "f.csv")).dtypes == [
        ("a", "int"),
        ("b", "string"),
    ]


def test_scratch_uses_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.fresh_path(spark, "t"), scratch.fresh_path(spark, "t")
    assert first.startswith(named + "/") and first != second


class _Session:
    """A session on a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_base(_Session)


def test_empty_texts_survive_a_partitioned_write(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, ""), (2, None), (3, "North")], "id int, region string"
    )
    path = str(tmp_path / "t")
    write_table(frame, path, partition_by=("region",), dry_run=False)
    back = read_partitioned(spark, path, frame.schema, ("region",))
    assert rows(back) == rows(frame)
    assert rows(back.where("region = ''")) == rows(frame.where("region = ''"))


def test_rejected_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "txns").mkdir()
    (tmp_path / "txns" / "f.csv").write_text(
        "txn_id,txn_ts,customer_id,product_id,quantity,channel\n"
        "a,2025-01-01 10:00:00,1,1,2,Online\n"
        "b,2025-01-01 10:00:00,1,1,two,Online\n"
        "c,2025-01-01 10:00:00,1\n"
        ",2025-01-01 10:00:00,1,1,2,Online\n"
        ",2025-01-01 10:00:00,2,1,2,Online\n"
    )
    for name, header in (
        ("dim_customers", "customer_id,customer_name,age,gender,country,region"),
        ("dim_products", "product_id,category,subcategory,product_name,base_price"),
    ):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(header + "\n")
    star = delimited.read_star_csv(spark, str(tmp_path))
    assert sorted(row.txn_id for row in star.txns.collect()) == ["a", "b", "c"]
    rejected = delimited.rejected_lines(spark, str(tmp_path))
    found = rejected["txns"].collect()
    assert sorted((row.txn_id or "", row.is_bad, row.has_key) for row in found) == [
        ("", False, False), ("", False, False), ("b", True, True), ("c", True, True),
    ]
    assert rejected["customers"].count() == 0


def test_scratch_of_an_application_goes_with_it(tmp_path):
    import subprocess
    import sys

    code = f"""
from tallyline.session import build_session
from tallyline.sinks.scratch import fresh_path
spark = build_session("scratch", master="local[1]", spark__checkpoint__dir={str(tmp_path)!r})
path = fresh_path(spark, "t")
spark.range(5).write.parquet(path)
print(spark.read.parquet(path).count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[1])
    assert done.stdout.strip() == "5"
    assert not list(tmp_path.glob("tallyline-*"))
