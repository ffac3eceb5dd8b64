"""Helpers shared by the operators: columns by exact name, tables, kept steps, shipped code."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sinks.scratch import fresh_path

PACKAGE = Path(__file__).resolve().parents[1]

#: For each application the folder of the archive that its workers fetch.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_place(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The frame with its columns renamed by place, and the new names of the given ones.

    Columns are found by exact name first, so neither ``Text`` beside ``text`` nor a dot in
    another column's name gets in the way.
    """
    places = [f"c{place}" for place in range(len(df.columns))]
    at, folded = {}, {}
    for place, name in zip(places, df.columns, strict=True):
        at.setdefault(name, place)
        folded.setdefault(name.lower(), place)
    return df.toDF(*places), [at.get(name) or folded[name.lower()] for name in names]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the frame holds."""
    plain, places = by_place(df, *names)
    return plain.select(
        *[F.col(place).alias(name) for place, name in zip(places, names, strict=True)]
    )


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends at a table that
    every executor can read, so a lost executor costs only its running tasks."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


#: Bytes and rows that a Python worker gets at once: texts may be long.
BATCH = {
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 * 1024 * 1024,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2_000,
}


def _number(setting: str) -> int:
    """A count or a size in bytes, as Spark writes them (``10000``, ``64m``, ``67108864b``)."""
    digits = setting.lower().removesuffix("b").rstrip("kmgt")
    unit = setting.lower().removesuffix("b")[len(digits) :]
    return int(digits) << 10 * " kmgt".index(unit or " ")


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once for each application, and see that the
    session hands them batches of bounded size (a smaller setting is left as it is)."""
    for name, most in BATCH.items():
        if not 0 < _number(spark.conf.get(name, str(most + 1))) <= most:
            spark.conf.set(name, str(most))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.TemporaryDirectory(prefix="run-tallyline-")
        archive = Path(folder.name) / f"{PACKAGE.name}-{context.applicationId}.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for path in sorted(PACKAGE.rglob("*.py")):
                packed.write(path, path.relative_to(PACKAGE.parent))
        context.addPyFile(str(archive))
        _shipped[context.applicationId] = folder
    return spark


class Recent(dict):
    """A dictionary of bounded size that keeps what was asked for lately: when it is full it
    becomes the old generation, from which entries are taken over as they are met again."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
