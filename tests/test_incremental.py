"""Late data: after any batch the store is what one run over all rows gives."""

import random
from pathlib import Path

import pytest
from frames import star, txn
from pyspark.sql import functions as F

from tallyline.operators.membership import may_have_key
from tallyline.plans import gold, incremental
from tallyline.plans.silver import silver

CUSTOMERS = [(1, "North"), (2, "South"), (3, None)]


def some(seed, n=120):
    """Repeated ids, invalid copies, unknown keys, ties and transactions without a time."""
    draw = random.Random(seed)
    return [
        txn(
            f"t{draw.randrange(80)}", draw.choice([1, 2, 3, 9]), draw.choice([1, 2, 7]),
            draw.choice([-1, 0, 1, 2, 3]),
            ts=draw.choice([None, *[f"2025-0{m}-1{d} 10:00:00" for m in range(1, 7) for d in range(2)]]),
            channel=draw.choice(["Online", "Store", None]),
        )
        for _ in range(n)
    ]


def given(spark, txns):
    return star(spark, txns, customers=CUSTOMERS)


def rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_batches_one_after_another(spark, tmp_path):
    loads = [some(1), some(2), some(3, n=15)]
    path, sums_path = str(tmp_path / "silver"), str(tmp_path / "sums")
    schema = incremental.store_silver(given(spark, loads[0]), path)
    sums = incremental.REGION_CATEGORY
    state = sums.store(incremental.stored_silver(spark, path, schema), sums_path)
    seen = list(loads[0])
    for load in loads[1:]:
        changes = incremental.upsert_silver(given(spark, load), path)
        sums.apply(changes, sums_path)
        seen += load
        whole = silver(given(spark, seen))
        assert rows(incremental.stored_silver(spark, path, schema)) == rows(whole)
        wanted = gold.monthly_region_category(whole).withColumnsRenamed(
            {"revenue": "total_amount", "units": "quantity"}
        )
        assert rows(sums.read(spark, sums_path, state).drop("row_count")) == rows(wanted)
    spend = incremental.CUSTOMERS.of(whole)
    assert rows(incremental.CUSTOMERS.added_up(spend, "region", "customer_id").drop("row_count")) == rows(
        gold.customer_spend(whole).withColumnRenamed("total_spent", "total_amount")
    )


def test_only_changed_months_are_written(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = [txn(f"a{m}", 1, 1, 5, ts=f"2025-0{m}-15 00:00:00") for m in range(1, 7)]
    schema = incremental.store_silver(given(spark, first), path)
    before = files(path)
    batch = [
        txn("a2", 2, 1, 5, ts="2025-01-31 00:00:00"),  # an earlier copy: moves to January
        txn("a3", 1, 1, 5, ts="2025-03-15 00:00:00"),  # what is there already
        txn("a4", 1, 1, 5, ts="2025-05-15 00:00:00"),  # a later copy: loses
        txn("b1", 1, 1, -5, ts="2025-06-15 00:00:00"),  # never valid
    ]
    changes = incremental.upsert_silver(given(spark, batch), path)
    assert set(changes.months) == {"202501", "202502"}
    assert changes.published.replaced == ("yyyymm=202501",)
    assert changes.published.removed == ("yyyymm=202502",)
    after = files(path)
    kept = {name: at for name, at in before.items() if "202501" not in name and "202502" not in name}
    assert kept.items() <= after.items() and len(kept) == 4
    assert rows(incremental.stored_silver(spark, path, schema)) == rows(silver(given(spark, first + batch)))


def test_sending_a_batch_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "silver")
    incremental.store_silver(given(spark, some(5)), path)
    incremental.upsert_silver(given(spark, some(6)), path)
    before = files(path)
    changes = incremental.upsert_silver(given(spark, some(6)), path)
    assert changes.months == () and changes.published is None
    assert changes.added.count() == changes.removed.count() == 0
    assert incremental.REGION_CATEGORY.apply(changes, path) is None
    assert files(path) == before


def test_empty_batch_and_empty_store(spark, tmp_path):
    path = str(tmp_path / "silver")
    schema = incremental.store_silver(given(spark, some(5)[:0]), path)
    assert incremental.upsert_silver(given(spark, []), path).months == ()
    incremental.upsert_silver(given(spark, some(7)), path)
    assert rows(incremental.stored_silver(spark, path, schema)) == rows(silver(given(spark, some(7))))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_filter_never_drops_a_key(spark, limit):
    table = spark.range(20_000).withColumn("key", F.concat(F.lit("k"), "id"))
    keys = table.where("id % 40 = 0").select("key").unionAll(spark.createDataFrame([(None,)], "key string"))
    found = may_have_key(table, keys, "key", keys.count(), limit=limit)
    assert found.join(keys, "key", "left_semi").count() == 500
    if limit:
        assert found.count() < 500 + 0.03 * 20_000
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    else:
        assert found.count() == 20_000
