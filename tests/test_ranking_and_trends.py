import random
from collections import defaultdict

import pytest
from frames import sales

from tallyline.functions.money import doubles
from tallyline.operators.ranking import top_overall, top_per_group
from tallyline.plans import gold, reports


def brute(rows, n, method):
    """(group, value, id) rows ranked in plain Python."""
    by_group = defaultdict(list)
    for group, value, key in rows:
        by_group[group].append((value, key))
    kept = set()
    for group, members in by_group.items():
        members.sort(key=lambda m: (-m[0], m[1]))
        distinct = sorted({value for value, _ in members}, reverse=True)
        for place, (value, key) in enumerate(members, 1):
            rank = {
                "dense_rank": distinct.index(value) + 1,
                "rank": 1 + sum(other > value for other, _ in members),
                "row_number": place,
            }[method]
            if rank <= n:
                kept.add((group, value, key, rank))
    return kept


@pytest.mark.parametrize("method", ["dense_rank", "rank", "row_number"])
@pytest.mark.parametrize("seed", [1, 2])
def test_top_per_group_equals_brute_force(spark, method, seed):
    draw = random.Random(seed)
    groups = ["a", "b", None, "hot", "hot", "hot"]
    rows = [(draw.choice(groups), draw.randint(1, 12), key) for key in range(600)]
    frame = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    for n in (1, 3, 50):
        found = top_per_group(frame, "g", "v", n, method, tie_break=["k"])
        assert {(r.g, r.v, r.k, r.rank) for r in found.collect()} == brute(rows, n, method)


def test_unknown_ranking_method(spark):
    with pytest.raises(ValueError):
        top_per_group(spark.range(1), "id", "id", 1, "ntile")


def test_ties_at_the_cut(spark):
    rows = [("N", c, "202501", a) for c, a in ((1, 9), (2, 8), (3, 8), (4, 7))]
    frame = sales(spark, rows)
    kept = {
        method: [(r.customer_id, r.rank) for r in gold.top_customers(frame, 2, method).collect()]
        for method in ("dense_rank", "rank", "row_number")
    }
    assert kept["dense_rank"] == [(1, 1), (2, 2), (3, 2)]
    assert kept["rank"] == [(1, 1), (2, 2), (3, 2)]
    assert kept["row_number"] == [(1, 1), (2, 2)]
    third = {m: gold.top_customers(frame, 3, m).collect()[-1] for m in ("dense_rank", "rank")}
    assert (third["dense_rank"].customer_id, third["dense_rank"].rank) == (4, 3)
    assert (third["rank"].customer_id, third["rank"].rank) == (3, 2)


def test_a_group_that_ties_as_a_whole_is_kept_whole(spark):
    rows = [("hot", c, "202501", 5) for c in range(2000)] + [("N", 1, "202501", 1)]
    top = gold.top_customers(sales(spark, rows).repartition(8)).collect()
    assert len(top) == 2001 and {row.rank for row in top} == {1}


def test_dense_ranks_have_no_gaps(spark):
    draw = random.Random(3)
    rows = [(draw.choice("AB"), c, "202501", draw.randint(1, 30)) for c in range(300)]
    ranks = defaultdict(set)
    for row in gold.top_customers(sales(spark, rows)).collect():
        ranks[row.region].add(row.rank)
    assert all(found == set(range(1, 11)) for found in ranks.values())


def test_top_overall_breaks_ties(spark):
    frame = spark.createDataFrame([(3, 5), (1, 5), (2, 9)], "k int, v int")
    assert [r.k for r in top_overall(frame, "v", 2, ["k"]).collect()] == [2, 1]


def trend(spark, months):
    frame = sales(spark, [("N", 1, month, amount) for month, amount in months])
    table = doubles(gold.revenue_trend(frame), "revenue", "rev_ma_3m")
    return [(r.yyyymm, r.rev_ma_3m) for r in table.collect()]


def test_moving_average_of_few_months(spark):
    assert trend(spark, [("202501", 10)]) == [("202501", 10.0)]
    assert trend(spark, [("202501", 10), ("202502", 20)]) == [("202501", 10.0), ("202502", 15.0)]


def test_moving_average_counts_rows_not_calendar_months(spark):
    found = trend(spark, [("202501", 10), ("202502", 20), ("202505", 60), ("202506", 1)])
    assert found[2:] == [("202505", 30.0), ("202506", 27.0)]


def test_growth(spark):
    months = [("202501", 10), ("202502", 15), ("202503", 0), ("202504", 5)]
    frame = sales(spark, [("N", 1, month, amount) for month, amount in months])
    found = [r.growth_pct for r in reports.month_growth(frame).orderBy("yyyymm").collect()]
    assert found == [None, 50.0, -100.0, None]


def test_monthly_report_joins_both_measures(spark):
    frame = sales(spark, [("N", 1, "202501", 10), ("N", 1, "202502", 20)])
    row = doubles(reports.monthly_report(frame), "revenue", "rev_ma_3m").collect()[1]
    assert tuple(row) == ("202502", 20.0, 15.0, 100.0)


def test_region_report_keeps_the_null_region(spark):
    rows = [(None, 1, "202501", 4), (None, 2, "202501", 6), ("N", 3, "202501", 5)]
    found = doubles(
        reports.region_report(sales(spark, rows)), "region_revenue", "total_spent"
    ).collect()
    assert [tuple(r) for r in found] == [
        (None, 10.0, 1, 2, 6.0),
        (None, 10.0, 2, 1, 4.0),
        ("N", 5.0, 1, 3, 5.0),
    ]
