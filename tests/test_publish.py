"""Publishing: what is not named keeps its files, what fails changes nothing."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline.sinks import publish
from tallyline.sinks.tables import read_partitioned, write_table

SCHEMA = "id int, month string, region string"
ROWS = [(k, m, r) for k in range(3) for m in ("01", "02", None) for r in ("N", "S", "", None)]
FOLDERS = ("month", "region")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame(ROWS, SCHEMA), path, partition_by=FOLDERS, dry_run=False)
    return path


def stored(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    read = read_partitioned(spark, path, schema, FOLDERS).select("id", "month", "region")
    return sorted((tuple(row) for row in read.collect()), key=repr)


def files(path):
    return {
        str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")
    }


def expect(rows):
    return sorted(rows, key=repr)


def test_other_months_keep_their_files(spark, table):
    before = files(table)
    new = spark.createDataFrame([(9, "02", "N"), (8, "02", "W")], SCHEMA)
    done = publish.replace_units(new, table, FOLDERS)
    assert done.replaced == ("month=02",) and done.removed == ()
    assert stored(spark, table) == expect(
        [row for row in ROWS if row[1] != "02"] + [(9, "02", "N"), (8, "02", "W")]
    )
    after = files(table)
    untouched = {name: at for name, at in before.items() if not name.startswith("month=02")}
    assert untouched.items() <= after.items()
    assert not [name for name in after if name.startswith("_")]


def test_null_and_empty_units(spark, table):
    new = spark.createDataFrame([(7, None, "N"), (6, "", None)], SCHEMA)
    publish.replace_units(new, table, FOLDERS, only=[(None,), ("",), ("01",)])
    kept = [row for row in ROWS if row[1] == "02"]
    assert stored(spark, table) == expect([*kept, (7, None, "N"), (6, "", None)])


def test_a_unit_may_be_finer(spark, table):
    new = spark.createDataFrame([(9, "02", "N")], SCHEMA)
    publish.replace_units(new, table, FOLDERS, unit=2)
    kept = [row for row in ROWS if row[1:] != ("02", "N")]
    assert stored(spark, table) == expect([*kept, (9, "02", "N")])


def test_rows_outside_of_what_may_change(spark, table):
    before = files(table)
    with pytest.raises(ValueError, match="month=01"):
        publish.replace_units(spark.createDataFrame([(9, "01", "N")], SCHEMA), table, FOLDERS, only=[("02",)])
    assert files(table) == before


def test_a_job_that_fails_changes_nothing(spark, table):
    before = files(table)
    broken = spark.createDataFrame([(1, "01", "N")], SCHEMA).withColumn(
        "id", F.when(F.rand(1) >= 0, F.raise_error("broken")).cast("int")
    )
    with pytest.raises(Exception, match="broken"):
        publish.replace_units(broken, table, FOLDERS)
    with pytest.raises(Exception, match="broken"):
        publish.replace_whole(broken, table, partition_by=FOLDERS)
    assert files(table) == before or {k: v for k, v in files(table).items() if not k.startswith("_")} == before
    assert stored(spark, table) == expect(ROWS)
    publish.recover(spark, table)
    assert files(table) == before


@pytest.mark.parametrize("failing", [1, 2, 3, 4])
def test_a_move_that_fails_is_undone(spark, table, monkeypatch, failing):
    moves, move = [], publish._Files.move

    def broken(self, source, target):
        moves.append(source)
        if len(moves) == failing:
            raise OSError("no more moves")
        move(self, source, target)

    before = files(table)
    monkeypatch.setattr(publish._Files, "move", broken)
    new = spark.createDataFrame([(9, "02", "N"), (9, "01", "N")], SCHEMA)
    with pytest.raises(OSError, match="no more moves"):
        publish.replace_units(new, table, FOLDERS)
    assert files(table) == before


@pytest.mark.parametrize("moves_made", [0, 1, 2, 3, 4, 5, 6])
def test_a_driver_that_dies_is_recovered_from(spark, table, monkeypatch, moves_made):
    """Every state between two moves: nothing is undone when the driver is gone."""
    moves, move = [], publish._Files.move

    class Died(BaseException):
        pass

    def dying(self, source, target):
        if len(moves) == moves_made:
            raise Died
        moves.append(source)
        move(self, source, target)

    before = files(table)
    monkeypatch.setattr(publish._Files, "move", dying)
    new = spark.createDataFrame([(9, "02", "N"), (9, "01", "N"), (9, "00", "N")], SCHEMA)
    try:
        publish.replace_units(new, table, FOLDERS)
    except Died:
        pass
    monkeypatch.undo()
    publish.recover(spark, table)
    if moves_made < 6:
        assert files(table) == before
    else:  # the last one made it final
        assert len(stored(spark, table)) == 4 * 3 + 3
    assert {f.name for f in Path(table).iterdir() if f.name[0] == "_"} == {"_SUCCESS"}


def test_a_new_table(spark, tmp_path):
    path = str(tmp_path / "new")
    publish.replace_units(spark.createDataFrame(ROWS, SCHEMA), path, FOLDERS)
    assert stored(spark, path) == expect(ROWS)
    nothing = spark.createDataFrame([], SCHEMA)
    publish.replace_units(nothing, path, FOLDERS, only=[("01",)])
    assert stored(spark, path) == expect([row for row in ROWS if row[1] != "01"])


def test_a_whole_table_changes_places(spark, table):
    new = spark.createDataFrame([(1, "09", "N")], SCHEMA)
    publish.replace_whole(new, table, partition_by=FOLDERS)
    assert stored(spark, table) == [(1, "09", "N")]
    parent = Path(table).parent
    assert [f.name for f in parent.iterdir()] == ["t"]
    (parent / "t").rename(parent / "t_replaced")
    publish.replace_whole(new.unionAll(new), table, partition_by=FOLDERS)
    assert len(stored(spark, table)) == 2
