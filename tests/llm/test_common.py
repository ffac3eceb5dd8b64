from llm_frames import documents

from tallyline.llm import common


def test_pick_goes_by_exact_name(spark):
    given = documents(spark, [(1, "a")]).withColumnRenamed("score", "text.x")
    assert common.pick(given, "doc_id", "text").collect() == [(1, "a")]
    assert common.pick(given, "TEXT").collect() == [("x",)]
    assert common.pick(given, "Doc_Id").columns == ["Doc_Id"]


def test_kept_reads_what_was_written(spark):
    rows = common.kept(spark.range(10), "rows")
    assert rows.count() == 10 and "parquet" in rows.inputFiles()[0]


def test_batches_are_bounded_and_smaller_ones_left(spark, set_conf):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_conf(spark__sql__execution__arrow__maxRecordsPerBatch="10000")
    common.ship(spark)
    assert spark.conf.get(name) == "2000"
    set_conf(spark__sql__execution__arrow__maxRecordsPerBatch="70")
    common.ship(spark)
    assert spark.conf.get(name) == "70"
    assert [common._number(x) for x in ("5", "64m", "64MB", "67108864b", "1g", "-1b")] == [
        5, 2**26, 2**26, 2**26, 2**30, -1,
    ]


def test_recent_stays_bounded_and_keeps_what_is_met(spark):
    recent = common.Recent(10)
    for number in range(100):
        if recent["hot"] is None:
            recent.put("hot", 1)
        recent.put(number, number + 1)
        assert len(recent) + len(recent.old) <= 21
        assert recent["hot"] == 1
    assert recent[99] == 100 and recent[0] is None
