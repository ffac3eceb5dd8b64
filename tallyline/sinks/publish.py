"""Publishing into a stored table without taking it away first.

The new rows are written to a folder beside the table. Only when all of them are there do folders
change places: an old one moves aside, the new one takes its name, and the old one goes when every
move has been made. A job that fails while it computes leaves the table as it was; a move that
fails is undone at once; and what a driver that died half way has left behind is undone by
``recover``, which every publish calls first.

The folders of the leading partition columns are the units that are replaced. A unit that the new
rows do not fill disappears; every unit that is not named keeps its files. The old units stand in
one folder, and renaming it is what makes a publish final. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tallyline.sinks.tables import EMPTY, Written, write_table

#: Readers skip names that begin with an underscore, so neither folder is ever read as data.
ASIDE = "_replaced"
STAGED = "_staged"
DONE = "_done"

#: Under the folder of old units, the units that the table did not have before.
NEW = "_new"

#: The name of a NULL's folder.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class _Files:
    """The few file system calls that publishing needs, on whichever system a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = self._path(path)
        self._files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.root.toString()}/{name}") if name else self.root

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self.at(name))

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self.at(target).getParent())
        if not self._files.rename(self.at(source), self.at(target)):
            raise OSError(f"{source} could not be moved to {target} in {self.root.toString()}")

    def make(self, name: str) -> None:
        self._files.mkdirs(self.at(name))

    def drop(self, name: str) -> None:
        self._files.delete(self.at(name), True)

    def folders(self, name: str, depth: int) -> list[str]:
        """Partition folders ``depth`` levels below ``name``, relative to it."""
        pattern = self.at("/".join([name, *["*=*"] * depth]).lstrip("/"))
        base = self.at(name).toUri().getPath().rstrip("/") + "/"
        return sorted(
            status.getPath().toUri().getPath().removeprefix(base)
            for status in self._files.globStatus(pattern) or []
            if status.isDirectory()
        )

    def named(self, prefix: str) -> list[str]:
        found = self._files.globStatus(self.at(f"{prefix}*")) or []
        return sorted(status.getPath().getName() for status in found)


@dataclass(frozen=True)
class Published:
    """Units that the table has new or changed, and units that it no longer has."""

    path: str
    replaced: tuple[str, ...]
    removed: tuple[str, ...]


def _value(folder: str) -> str | None:
    value = unquote(folder.split("=", 1)[1])
    return None if value == NULL_FOLDER else "" if value == EMPTY else value


def unit_values(unit: str) -> tuple[str | None, ...]:
    """The partition values of a unit's folder, as text."""
    return tuple(_value(folder) for folder in unit.split("/"))


def recover(spark: SparkSession, path: str) -> list[str]:
    """Undo what an unfinished publish has moved, and drop what it had staged. Returns the units
    that were put back."""
    files = _Files(spark, path)
    back = []
    for aside in files.named(ASIDE):
        depth = int(aside.split("-")[1])
        for unit in files.folders(f"{aside}/{NEW}", depth):
            files.drop(unit)
        for unit in files.folders(aside, depth):
            if files.exists(unit):
                files.drop(unit)
            files.move(f"{aside}/{unit}", unit)
            back.append(unit)
        files.drop(aside)
    for leftover in [*files.named(STAGED), *files.named(DONE)]:
        files.drop(leftover)
    return back


def replace_units(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    unit: int = 1,
    only: Sequence[Sequence[str | None]] | None = None,
    grouped: bool = True,
) -> Published:
    """Put ``df`` in the place of the units it has rows for.

    ``unit`` is how many of the partition columns name a unit: with (year, month, region) and 2, a
    month is replaced with all its regions, also regions it no longer has. ``only`` names the
    units that may change, by their values as text: one of them without new rows is removed, and
    rows for any other unit are an error, before anything has moved.
    """
    spark = df.sparkSession
    files = _Files(spark, path)
    recover(spark, path)
    run = uuid.uuid4().hex
    staged, aside = f"{STAGED}-{run}", f"{ASIDE}-{unit}-{run}"
    write_table(df, f"{path.rstrip('/')}/{staged}", partition_by=partition_by, grouped=grouped, dry_run=False)

    new = files.folders(staged, unit)
    held = set(files.folders("", unit))
    gone: list[str] = []
    if only is not None:
        allowed = {tuple(values) for values in only}
        stray = [folder for folder in new if unit_values(folder) not in allowed]
        if stray:
            files.drop(staged)
            raise ValueError(f"rows for units that may not change: {stray[:5]}")
        gone = sorted(folder for folder in held - set(new) if unit_values(folder) in allowed)

    for folder in new:
        if folder not in held:
            files.make(f"{aside}/{NEW}/{folder}")
    moved: list[tuple[str, str]] = []
    try:
        for folder in [*new, *gone]:
            if folder in held:
                files.move(folder, f"{aside}/{folder}")
                moved.append((f"{aside}/{folder}", folder))
            if folder in new:
                files.move(f"{staged}/{folder}", folder)
                moved.append((folder, f"{staged}/{folder}"))
    except Exception:
        for source, target in reversed(moved):
            files.move(source, target)
        files.drop(aside)
        files.drop(staged)
        raise
    if files.exists(aside):
        files.move(aside, f"{DONE}-{run}")
        files.drop(f"{DONE}-{run}")
    files.drop(staged)
    return Published(path, tuple(new), tuple(gone))


def replace_whole(df: DataFrame, path: str, **options) -> Written:
    """``write_table`` to a folder beside the table, then the two change places: the old table is
    there until the new one is complete. A driver that dies between the moves leaves the old one
    under ``<path>_replaced``, from where the next call puts it back."""
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    files = _Files(spark, parent)
    old, staged = f"{name}{ASIDE}", f"{name}{STAGED}"
    if files.exists(old) and not files.exists(name):
        files.move(old, name)
    for leftover in (old, staged):
        files.drop(leftover)
    done = write_table(df, f"{parent}/{staged}", dry_run=False, **options)
    held = files.exists(name)
    if held:
        files.move(name, old)
    try:
        files.move(staged, name)
    except Exception:
        if held:
            files.move(old, name)
        raise
    files.drop(old)
    return replace(done, path=path)
