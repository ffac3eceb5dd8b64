import random
from collections import defaultdict

import pytest
from frames import star, txn
from pyspark.sql import functions as F

from tallyline.jobs.compare import join_types, plan_text
from tallyline.operators import joins
from tallyline.plans import silver as clean


def test_measured_bytes_counts_contents(spark):
    frame = spark.createDataFrame([("ab", 1), (None, 2), ("é", 3)], "s string, n int")
    empty = frame.limit(0)
    small, none = joins.measured_bytes(frame, empty)
    assert small == 3 * (joins.ROW_OVERHEAD + 2 * joins.FIELD_BYTES) + 4
    assert none == 0


def test_broadcast_depends_on_the_measure(spark, set_conf):
    set_conf(spark__sql__autoBroadcastJoinThreshold=-1)
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    side = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = joins.join_dimensions(facts, [("k", side)])
    large = joins.join_dimensions(facts, [("k", side)], limit=1)
    assert join_types(small) == ["BroadcastHashJoin"]
    assert join_types(large) == ["SortMergeJoin"]
    assert sorted(small.collect()) == sorted(large.collect())


def test_merge_is_forced_for_one_join_only(spark):
    facts = spark.range(100).withColumn("k", F.col("id") % 10)
    side = spark.range(10).select(F.col("id").alias("k"))
    assert join_types(joins.join_dimensions(facts, [("k", side)], strategy="merge")) == [
        "SortMergeJoin"
    ]
    assert join_types(joins.join_dimensions(facts, [("k", side)], strategy="auto")) == [
        "BroadcastHashJoin"
    ]
    with pytest.raises(ValueError):
        joins.join_dimensions(facts, [("k", side)], strategy="nested")


def test_fan_out_and_its_sum_equal_brute_force(spark):
    draw = random.Random(5)
    states = ["hot"] * 10 + list("abcdefgh") + [None]
    facts = [(draw.choice(states), draw.randint(1, 9)) for _ in range(500)]
    pairs = [(draw.choice(states + ["zz"]), draw.randint(1, 5)) for _ in range(50)]
    expected = defaultdict(int)
    n = 0
    for state, value in facts:
        for other, category in pairs:
            if state is not None and state == other:
                expected[category] += value
                n += 1
    left = spark.createDataFrame(facts, "state string, sales bigint")
    right = spark.createDataFrame(pairs, "state string, category bigint")
    assert joins.fan_out(left, right, "state").count() == n
    assert joins.fan_out(left, right, "state", "broadcast").count() == n
    summed = joins.fanned_out_sum(left, right, "state", "category", "sales").collect()
    assert {row.category: row.sales for row in summed} == dict(expected)


def hot_star(spark):
    """A third of the rows share one customer, one product and one transaction id."""
    txns = [txn("hot", 1, 1, 1 + n % 4) for n in range(1000)]
    txns += [txn(f"t{n}", n % 50, n % 20, n % 6 - 1) for n in range(2000)]
    return star(
        spark,
        txns,
        customers=[(key, f"r{key % 3}") for key in range(40)],
        products=[(key, f"c{key % 4}", float(key % 7)) for key in range(18)],
    )


def test_hot_keys_without_broadcast_give_the_same_rows(spark, set_conf):
    given = hot_star(spark)
    expected = sorted(map(str, clean.silver(given).collect()))
    set_conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
    )
    shuffled = clean.silver(given, limit=0)
    assert sorted(map(str, shuffled.collect())) == expected
    assert join_types(shuffled) == ["SortMergeJoin"]


def test_copies_are_dropped_before_the_shuffle(spark):
    given = hot_star(spark)
    plan = plan_text(clean.sales(given, product_attributes=False))
    assert plan.count("WindowGroupLimit [txn_id") == 2


def test_a_hot_key_is_split_when_the_side_is_too_large(spark, set_conf):
    """A third of the facts on one key: the shuffle join reads that partition in parts."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    facts = spark.range(0, 300_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k")
    )
    side = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for how, expected in (("left", 300_000), ("inner", 200_000)):
        joined = joins.join_dimensions(facts, [("k", side)], how=how, limit=1).select("id", "v")
        assert len(joined.collect()) == expected
        if how == "left":
            assert "skew=true" in plan_text(joined)
