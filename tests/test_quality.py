"""Constraints, profiles, inferred types, cubes."""

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import catalog
from tallyline.operators import constraints, profile
from tallyline.operators.constraints import Check, ForeignKey, Unique
from tallyline.plans import cubes
from tallyline.sinks.tables import write_csv
from tallyline.sources import delimited, inference


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Constraints

ROWS = [
    ("a", 1, 5), ("b", 2, None), ("c", None, 5), ("d", 99, -1), ("d", 99, 4), ("e", 98, 0),
    (None, 1, 5), (None, 1, -2), ("f", 3, 11),
]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(ROWS, "id string, ref int, amount int")


@pytest.fixture
def rules(spark):
    known = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "key int")
    return [
        constraints.within("amount", "amount", 1, 10),
        ForeignKey("ref", "ref", known, "key"),
        Unique("once"),
    ]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_violations(facts, rules, limit):
    found = constraints.violations(facts, "id", rules, limit=limit).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [
            ("b", "amount", 1), ("d", "amount", 1), ("d", "ref", 2), ("d", "once", 2), ("e", "amount", 1),
            ("e", "ref", 1), ("f", "amount", 1), (None, "amount", 1), (None, "once", 2),
        ],
        key=str,
    )


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_no_row_is_lost(facts, rules, limit):
    good, bad = constraints.quarantined(facts, "id", rules, limit=limit)
    assert sorted(map(tuple, good.collect())) == [("a", 1, 5), ("c", None, 5)]
    assert sorted((tuple(r)[:3] for r in bad.collect()), key=str) == sorted(
        (row for row in ROWS if row not in [("a", 1, 5), ("c", None, 5)]), key=str
    )
    broken = {(r.id, r.amount): r.broken for r in bad.collect()}
    assert broken["d", -1] == ["amount", "ref", "once"] and broken["e", 0] == ["amount", "ref"]


def test_rules_cost_one_shuffle(facts):
    checks = [Check(f"r{k}", F.col("amount") > k) for k in range(5)]
    found = constraints.violations(facts, "id", [*checks, Unique("once")])
    assert plan_of(found).count("Exchange") == 1
    assert constraints.violations(facts, "id", [Check("fine", F.lit(True))]).count() == 0
    with pytest.raises(ValueError, match="one name"):
        constraints.tagged(facts, [Check("x", F.lit(True)), Unique("x")])


def test_many_missing_keys_go_through_the_filter(spark):
    facts = spark.range(30_000).select(F.col("id").cast("string").alias("id"), "id", (F.col("id") % 9_000).alias("r"))
    facts = facts.toDF("key", "id", "r")
    rule = ForeignKey("ref", "r", spark.range(0, 9_000, 3).toDF("k"), "k")
    found = constraints.violations(facts, "key", [rule], limit=0)
    assert found.count() == 20_000


# Profiles


def test_profile_is_near(spark):
    draw = random.Random(3)
    values = [(k, draw.choice([None, "x", "y", f"v{k % 900}"]), draw.gauss(0, 9), k % 2 == 0) for k in range(20_000)]
    rows = spark.createDataFrame(values, "k bigint, t string, g double, b boolean").withColumn(
        "d", F.expr("date_add(date'2020-01-01', cast(k % 100 as int))")
    ).withColumn("none", F.lit(None).cast("int"))
    found = {r.column_name: r for r in profile.column_profile(rows.repartition(7), parts=3).collect()}
    assert list(found) == rows.columns
    for name, column in (("k", 0), ("t", 1), ("g", 2), ("b", 3)):
        known = [v[column] for v in values if v[column] is not None]
        counts = Counter(known)
        got = found[name]
        assert (got.row_count, got.null_count) == (20_000, 20_000 - len(known))
        assert abs(got.distinct_count - len(counts)) <= profile.DISTINCT_ERROR * len(counts) + 1
        if name in "kg":
            ordered = sorted(known)
            for p, text in zip(profile.QUANTILES, got.quantiles, strict=True):
                below = sum(v < float(text) for v in ordered)
                upto = sum(v <= float(text) for v in ordered)
                slack = profile.RANK_ERROR * len(known) + 1
                assert below - slack <= p * len(known) <= upto + slack
            assert float(got.quantiles[0]) == ordered[0] and float(got.quantiles[-1]) == ordered[-1]
        if name == "t":
            top = {r["value"]: r["count"] for r in got.frequent}
            for value, count in counts.most_common(2):
                assert abs(top[value] - count) <= 3.5 * len(known) / profile.TRACKED + 1
    assert found["d"].quantiles[0] == "2020-01-01" and found["d"].quantiles[-1] == "2020-04-09"
    assert found["none"].null_count == 20_000 and found["none"].quantiles is None


def test_profile_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "a int, t string")
    found = profile.column_profile(rows).collect()
    assert [(r.column_name, r.row_count, r.null_count, r.distinct_count) for r in found] == [
        ("a", 0, 0, 0), ("t", 0, 0, 0)
    ]


def test_profile_reads_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS m", "string(id) AS t").write.parquet(str(tmp_path / "p"))
    plan = plan_of(profile.column_profile(spark.read.parquet(str(tmp_path / "p"))))
    assert plan.count("FileScan") == 1 and "Expand" not in plan


def test_each_column_is_counted_once(spark, tmp_path):
    """What sketches claim is compared with one count of each column, and false claims are found."""
    values = [(k, f"v{k % 3}", None, Decimal(k % 7), k / 4, date(2020, 1, 1 + k % 9)) for k in range(500)]
    schema = "k bigint, t string, none int, d decimal(9,2), f double, day date"
    spark.createDataFrame(values, schema).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    profile.column_profile(rows, parts=3).write.parquet(str(tmp_path / "found"))
    found = spark.read.parquet(str(tmp_path / "found"))
    near = catalog._near_profile(rows, found)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == len(rows.columns) + 2
    assert near.where("distinct_is_near AND frequent_is_near").count() == len(rows.columns)
    assert near.where("column_name = 'none'").collect()[0].null_count == 500

    def changed(name, **columns):
        new = [F.when(F.col("column_name") == name, columns[c]).otherwise(F.col(c)).alias(c)
               if c in columns else F.col(c) for c in found.columns]
        row = catalog._near_profile(rows, found.select(new)).where(F.col("column_name") == name).collect()[0]
        return row.distinct_is_near, row.frequent_is_near

    def claim(value, count):
        return F.array(F.struct(F.lit(value).alias("value"), F.lit(count).cast("long").alias("count")))

    assert changed("t", frequent=claim("v0", 167)) == (True, True)
    assert changed("t", frequent=claim("v0", 150)) == changed("t", frequent=claim("other", 5)) == (True, False)
    assert changed("d", frequent=claim("1.00", 72)) == changed("f", frequent=claim("0.25", 1)) == (True, True)
    assert changed("day", frequent=claim("2020-01-01", 40)) == (True, False)
    assert changed("k", distinct_count=F.lit(400).cast("long")) == (False, True)


# Inferred types


def csv(spark, path, columns, rows):
    write_csv(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)), path, dry_run=False)


def test_types_climb_the_lattice(spark, tmp_path):
    columns = ["i", "l", "d", "day", "at", "b", "t", "none", "late"]
    rows = [
        ("1", "3000000000", "1.5", "2020-01-31", "2020-01-31 10:00:00", "true", "x", None, "7"),
        ("-20", "1", "2", "2021-02-28", "2021-02-28", "FALSE", "1", None, "8"),
        (None, "+5", "1e3", None, None, None, "", None, "9.25"),
    ]
    csv(spark, str(tmp_path / "c"), columns, rows)
    schema, report = inference.infer_csv(spark, str(tmp_path / "c"))
    assert [f.dataType.simpleString() for f in schema] == [
        "int", "bigint", "double", "date", "timestamp_ntz", "boolean", "string", "string", "double",
    ]
    assert {r.misfits for r in report.collect()} == {0}
    read = delimited.read_typed_csv(spark, str(tmp_path / "c"), schema)
    assert read.where("is_bad").count() == 0 and read.count() == 3


def test_misfits_are_counted_over_all_rows(spark, tmp_path):
    rows = [(str(k), "2020-02-30" if k % 4 == 0 else "2020-02-28") for k in range(4_000)]
    rows += [("x", None)] * 10 + [("9999999999", None)]
    csv(spark, str(tmp_path / "c"), ["n", "day"], rows)
    schema, report = inference.infer_csv(spark, str(tmp_path / "c"), tolerance=0.3)
    found = {r.column_name: (r.type, r.value_count, r.misfits) for r in report.collect()}
    assert found == {"n": ("bigint", 4_011, 10), "day": ("date", 4_000, 1_000)}
    read = delimited.read_typed_csv(spark, str(tmp_path / "c"), schema)
    assert read.where("is_bad").count() == 1_010
    strict, _ = inference.infer_csv(spark, str(tmp_path / "c"))
    assert {f.dataType.simpleString() for f in strict} == {"string"}


def test_types_need_one_pass(spark, tmp_path):
    csv(spark, str(tmp_path / "c"), ["a", "b"], [("1", "2")])
    text = delimited.read_text_csv(spark, str(tmp_path / "c"), ["a", "b"])
    plan = plan_of(inference.inferred_types(text, ["a", "b"]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


# Cubes

SALES = [
    ("01", "N", "toys", 1, 2, 10.0), ("01", None, "toys", 1, 1, 5.0), ("01", None, "books", 2, 1, 2.5),
    ("02", "N", "toys", 1, 4, 20.0), (None, "N", "toys", 3, 4, 20.0),
]


@pytest.fixture
def sales(spark, tmp_path):
    schema = "yyyymm string, region string, category string, customer_id long, quantity int, total_amount double"
    spark.createDataFrame(SALES, schema).write.parquet(str(tmp_path / "sales"))
    return spark.read.parquet(str(tmp_path / "sales"))


def by_hand(measure):
    out = {}
    for grain, mask in enumerate(range(8)):
        for row in SALES:
            key = tuple(None if mask >> (2 - k) & 1 else row[k] for k in range(3))
            out.setdefault((grain, key), []).append(row)
    return {key: measure(rows) for key, rows in out.items()}


def test_cube_tells_null_from_total(sales):
    cube = cubes.revenue_cube(sales)
    plan = plan_of(cube)
    got = {
        (r.grain, (r.yyyymm, r.region, r.category)): (r.revenue, r.units, r.row_count)
        for r in cube.collect()
    }
    assert got == by_hand(lambda rows: (sum(r[5] for r in rows), sum(r[4] for r in rows), len(rows)))
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 1
    some = cubes.revenue_cube(sales, grains=[["yyyymm"], []])
    assert {r.grain for r in some.collect()} == {0b011, 0b111}


def test_distinct_customers_of_any_grain(sales):
    wanted = by_hand(lambda rows: len({r[3] for r in rows}))
    exact = cubes.distinct_customers_exact(sales)
    about = cubes.distinct_customers(cubes.customer_sketches(sales))
    assert plan_of(about).count("Expand") == 1
    keys = lambda r: (r.grain, (r.yyyymm, r.region, r.category))
    assert {keys(r): r.customer_count for r in exact.collect()} == wanted
    assert {keys(r): r.estimate for r in about.collect()} == wanted


def test_sketches_stay_within_their_error(spark):
    rows = spark.range(200_000).selectExpr(
        "CAST(id % 12 AS STRING) yyyymm", "CAST(id % 5 AS STRING) region", "'c' category",
        "xxhash64(id) % 60000 customer_id",
    )
    about = {r.yyyymm: r.estimate for r in cubes.distinct_customers(cubes.customer_sketches(rows), grains=[["yyyymm"], []]).collect()}
    exact = {r.yyyymm: r.customer_count for r in cubes.distinct_customers_exact(rows, grains=[["yyyymm"], []]).collect()}
    assert set(about) == set(exact)
    for month, count in exact.items():
        assert abs(about[month] - count) <= cubes.ERROR * count
