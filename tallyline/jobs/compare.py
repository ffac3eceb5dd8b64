"""Time the three physical modes on equal inputs, after checking that their rows agree.

``python -m tallyline.jobs.compare --base DIR`` reads tables written by the generate job.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans.modes import MODES, joined
from tallyline.session import build_session
from tallyline.sources.tables import read_all, read_table

JOIN_NODE = re.compile(r"\b(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)\b")


class ModesDisagree(AssertionError):
    """Two modes gave different rows: their times would not be comparable."""


@dataclass(frozen=True)
class Measured:
    mode: str
    seconds: float
    join_types: str
    shuffle_read_bytes: int
    shuffle_write_bytes: int
    result_rows: int


def plan_text(df: DataFrame) -> str:
    """The plan as ``explain`` prints it; after an action, the final adaptive plan."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain()
    return printed.getvalue()


def join_types(df: DataFrame) -> list[str]:
    """Physical join operators of the final plan."""
    text = plan_text(df).split("== Initial Plan ==")[0]
    return sorted(set(JOIN_NODE.findall(text)))


def _stages(spark: SparkSession) -> list:
    """Stages the session remembers; the web interface need not run for that."""
    context = spark.sparkContext
    no_quantiles = context._gateway.new_array(context._jvm.double, 0)
    found = context._jsc.sc().statusStore().stageList(None, False, False, no_quantiles, None)
    return [found.apply(position) for position in range(found.size())]


def last_stage(spark: SparkSession) -> int:
    return max((stage.stageId() for stage in _stages(spark)), default=-1)


def shuffle_bytes(spark: SparkSession, after: int, patience: float = 5.0) -> tuple[int, int]:
    """Shuffle bytes read and written by the stages later than ``after``.

    Stage reports arrive a little after the results, so running ones are waited for.
    """
    deadline = time.monotonic() + patience
    while True:
        remembered = _stages(spark)
        if after >= 0 and all(stage.stageId() > after for stage in remembered):
            raise RuntimeError(
                "the session has forgotten stages; raise spark.ui.retainedStages"
            )
        stages = [stage for stage in remembered if stage.stageId() > after]
        running = any(stage.status().toString() == "ACTIVE" for stage in stages)
        if not running or time.monotonic() > deadline:
            break
        time.sleep(0.05)
    return (
        sum(stage.shuffleReadBytes() for stage in stages),
        sum(stage.shuffleWriteBytes() for stage in stages),
    )


OUTPUT_COLUMNS = ("region", "category", "quantity")


def outputs(frame: DataFrame) -> list[DataFrame]:
    """Several small tables from one joined frame, so that keeping it can pay off."""
    return [
        frame.groupBy("region").agg(F.count(F.lit(1)).alias("row_count")),
        frame.groupBy("category").agg(F.sum("quantity").alias("units")),
        frame.groupBy("region", "category").agg(F.sum("quantity").alias("units")),
    ]


def fingerprint(table: DataFrame) -> DataFrame:
    """Row count and order-free checksum: equal tables give equal rows, of any size."""
    checksum = F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))
    return table.agg(F.count(F.lit(1)).alias("row_count"), checksum.alias("checksum"))


def run_mode(
    spark: SparkSession,
    mode: str,
    facts: DataFrame,
    dimensions: Sequence[tuple[str, DataFrame]],
) -> tuple[Measured, list]:
    """One timed run and the fingerprints of its output tables."""
    before = last_stage(spark)
    started = time.perf_counter()
    with joined(mode, facts, dimensions, OUTPUT_COLUMNS) as frame:
        prints = [fingerprint(table) for table in outputs(frame)]
        found = [frame.collect()[0] for frame in prints]
        seconds = time.perf_counter() - started
        joins = join_types(prints[0])
    read, written = shuffle_bytes(spark, before)
    measured = Measured(
        mode,
        round(seconds, 3),
        "+".join(joins),
        read,
        written,
        sum(row.row_count for row in found),
    )
    return measured, found


def compare(
    spark: SparkSession,
    facts: DataFrame,
    dimensions: Sequence[tuple[str, DataFrame]],
    modes: Sequence[str] = MODES,
    repeats: int = 3,
) -> DataFrame:
    """One row per mode: best time of ``repeats`` after a warm-up that checks the rows."""
    expected = None
    best: dict[str, Measured] = {}
    for mode in modes:
        _, found = run_mode(spark, mode, facts, dimensions)
        if expected is None:
            expected = found
        elif found != expected:
            raise ModesDisagree(f"{mode} differs from {modes[0]}")
    for _ in range(repeats):
        for mode in modes:
            measured, found = run_mode(spark, mode, facts, dimensions)
            if found != expected:
                raise ModesDisagree(f"{mode} changed its rows between runs")
            if mode not in best or measured.seconds < best[mode].seconds:
                best[mode] = measured
    return spark.createDataFrame([asdict(best[mode]) for mode in modes]).select(
        *[field.name for field in fields(Measured)]
    )


def keyed_inputs(spark: SparkSession, base: str):
    """Facts and dimensions of the text-keyed tables; the two ``name`` columns are told apart."""
    names = ("transactions", "customers", "products")
    paths = [f"{base.rstrip('/')}/{name}" for name in names]
    facts, customers, products = read_all(paths, lambda path: read_table(spark, path))
    return facts, [
        ("customer_id", customers.withColumnRenamed("name", "customer_name")),
        ("product_id", products.withColumnRenamed("name", "product_name")),
    ]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--base", required=True, help="folder with the text-keyed tables")
    parser.add_argument("--modes", nargs="+", choices=MODES, default=list(MODES))
    parser.add_argument("--repeats", type=int, default=3)
    args = parser.parse_args(argv)
    spark = build_session("tallyline-compare")
    facts, dimensions = keyed_inputs(spark, args.base)
    compare(spark, facts, dimensions, args.modes, args.repeats).show(truncate=False)


if __name__ == "__main__":
    main()
