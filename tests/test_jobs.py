from pathlib import Path

import pytest
from frames import star, txn

from tallyline.jobs import compare, etl, generate
from tallyline.plans import incremental, views
from tallyline.sources.delimited import read_star_csv
from tallyline.sources.tables import MissingTables, RepeatedKeys, read_star

SAMPLE = [
    txn(f"t{n % 90}", n % 3, n % 4, n % 5, ts=f"2025-0{n % 3 + 1}-10 08:00:00")
    for n in range(200)
]


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_dry_run_and_written_run_agree(spark, tmp_path):
    given = star(spark, SAMPLE)
    out = str(tmp_path / "out")
    with etl.run(spark, given, out) as dry:
        expected = {name: rows(table) for name, table in dry.gold.items()}
        clean = rows(dry.silver)
        assert dry.silver_rows == len(clean) and dry.silver.is_cached
        assert not any(w.done for w in dry.written)
    assert not dry.silver.is_cached
    assert not Path(out).exists()
    with etl.run(spark, given, out, dry_run=False) as wet:
        assert {name: rows(table) for name, table in wet.gold.items()} == expected
        assert rows(wet.silver.select(*dry.silver.columns)) == clean
        assert all(w.done for w in wet.written) and len(wet.written) == 5 + len(incremental.SUMS)
    for name in expected:
        assert rows(spark.read.parquet(f"{out}/{name}")) == expected[name]
    assert (tmp_path / "out/silver_orders/yyyymm=202501").is_dir()


def test_a_late_batch_gives_what_one_run_over_all_gives(spark, tmp_path):
    late = [txn(f"t{n % 150}", n % 4, n % 3, n % 4, ts=f"2025-0{n % 5 + 1}-09 08:00:00") for n in range(160)]
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    with etl.run(spark, star(spark, SAMPLE + late), one, dry_run=False):
        pass
    with etl.run(spark, star(spark, SAMPLE), two, dry_run=False):
        pass
    changes = etl.late(spark, star(spark, late), two)
    assert "202505" in changes.months
    for name in ("silver_orders", "gold_monthly_region_cat", "gold_top_customers", "gold_rev_trend",
                 "gold_top_products", *incremental.SUMS):
        ours, whole = (spark.read.parquet(f"{base}/{name}") for base in (two, one))
        assert ours.schema == whole.schema and rows(ours) == rows(whole)


def test_views_answer_sql(spark):
    with etl.run(spark, star(spark, SAMPLE)) as result:
        months = spark.sql("SELECT DISTINCT yyyymm FROM silver_orders ORDER BY 1").collect()
        assert [r.yyyymm for r in months] == ["202501", "202502", "202503"]
        for name, table in result.gold.items():
            assert rows(spark.table(name)) == rows(table)
        assert spark.sql(views.TREND).count() == 3


def test_write_needs_a_folder(spark):
    with pytest.raises(ValueError), etl.run(spark, star(spark, SAMPLE), dry_run=False):
        pass


def test_repeated_dimension_keys_stop_the_run(spark):
    given = star(spark, SAMPLE, customers=[(1, "N"), (1, "S")])
    with pytest.raises(RepeatedKeys), etl.run(spark, given):
        pass


def test_generate_then_etl_from_the_command_line(spark, tmp_path, capsys, monkeypatch):
    for module in (generate, etl, compare):
        monkeypatch.setattr(module, "build_session", lambda *a, **k: spark)
    base, out = str(tmp_path / "raw"), str(tmp_path / "out")
    sizes = ["--num_customers", "50", "--num_products", "20", "--num_txns", "500"]
    generate.main(["--base", base, *sizes])
    assert not Path(base).exists()
    generate.main(["--base", base, "--write", *sizes])
    assert read_star(spark, base).txns.count() == 500
    etl.main(["--input", base, "--output", out, "--write", "--top_n", "3"])
    assert "clean sales: 500 rows" in capsys.readouterr().out
    top = spark.read.parquet(f"{out}/gold_top_customers")
    assert top.agg({"rank": "max"}).first()[0] == 3
    keyed = str(tmp_path / "keyed")
    generate.main(["--base", keyed, "--family", "keyed", "--write", *sizes])
    assert len(list(Path(keyed, "transactions").glob("part-*"))) == generate.LEAST_FILES
    compare.main(["--base", keyed, "--repeats", "1"])
    printed = capsys.readouterr().out
    assert "SortMergeJoin" in printed and "BroadcastHashJoin" in printed


def test_csv_star_gives_the_same_tables(spark, tmp_path):
    tables = generate.star_frames(spark, 50, 20, 500)
    generate.write_star(tables, str(tmp_path / "parquet"), dry_run=False)
    generate.write_star_csv(tables, str(tmp_path / "csv"), dry_run=False)
    found = []
    for given in (
        read_star(spark, str(tmp_path / "parquet")),
        read_star_csv(spark, str(tmp_path / "csv")),
    ):
        with etl.run(spark, given) as result:
            found.append({name: rows(table) for name, table in result.gold.items()})
    assert found[0] == found[1]
    with pytest.raises(MissingTables):
        read_star_csv(spark, str(tmp_path / "none"))


def test_compare_gives_equal_rows_and_less_shuffle(spark, tmp_path):
    base = str(tmp_path / "keyed")
    generate.write_keyed(generate.keyed_frames(spark, 50, 20, 2000), base, dry_run=False)
    facts, dimensions = compare.keyed_inputs(spark, base)
    table = {r.mode: r for r in compare.compare(spark, facts, dimensions, repeats=1).collect()}
    assert table["broadcast"].shuffle_write_bytes < table["baseline"].shuffle_write_bytes
    assert len({r.result_rows for r in table.values()}) == 1
    with pytest.raises(MissingTables):
        compare.keyed_inputs(spark, str(tmp_path / "none"))


def test_shuffle_bytes_survive_forgotten_stages(spark):
    """Only later stages count: what the session has forgotten meanwhile does not matter."""
    before = compare.last_stage(spark)
    spark.range(1000).repartition(3).selectExpr("sum(id)").collect()
    read, written = compare.shuffle_bytes(spark, before)
    assert read > 0 and written > 0
    assert compare.shuffle_bytes(spark, compare.last_stage(spark)) == (0, 0)


def test_modes_that_differ_are_refused(spark, monkeypatch):
    answers = iter([(None, [1]), (None, [2])])
    monkeypatch.setattr(compare, "run_mode", lambda *a: next(answers))
    with pytest.raises(compare.ModesDisagree):
        compare.compare(spark, None, [], modes=("baseline", "broadcast"))


def test_state_frames(spark):
    frames = generate.state_frames(spark, 100)
    assert frames["sales"].count() == 100 and frames["state_category"].count() == 50
