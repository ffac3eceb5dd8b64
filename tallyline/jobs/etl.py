"""Raw star to clean sales to business tables.

``python -m tallyline.jobs.etl --input DIR --output DIR --write``

With ``--write`` the clean sales are stored first and the business tables read the stored
copy, so a lost executor never costs the joins and the deduplication again. A dry run writes
nothing and keeps the clean sales on the executors while the samples are shown. Parquet tables
change places with the old ones only when they are complete.

``--late`` brings the transactions of the input into what an earlier run has stored: only the
months they change are written again, and the business tables come from sums that are kept up to
date, not from all sales.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.layout import persisted
from tallyline.plans import incremental, views
from tallyline.plans.gold import TOP_CUSTOMERS, gold_tables
from tallyline.plans.reports import head_reports, silver_sample
from tallyline.plans.silver import silver
from tallyline.session import build_session
from tallyline.sinks.publish import replace_whole
from tallyline.sinks.tables import Written, read_partitioned, write_table
from tallyline.sources.delimited import read_star_csv, rejected_lines
from tallyline.sources.tables import Star, read_star, read_table, require_unique_key

SILVER_PARTITIONS = ("yyyymm", "region")


@dataclass
class Result:
    """Frames of one run; usable inside the ``run`` block."""

    silver: DataFrame
    gold: dict[str, DataFrame]
    written: list[Written] = field(default_factory=list)
    silver_rows: int = 0
    silver_seconds: float = 0.0


@contextmanager
def run(
    spark: SparkSession,
    star: Star,
    output: str | None = None,
    *,
    dry_run: bool = True,
    fmt: str = "parquet",
    top_n: int = TOP_CUSTOMERS,
) -> Iterator[Result]:
    """Build, optionally store, and register all tables as SQL views."""
    if not dry_run and not output:
        raise ValueError("an output folder is needed unless this is a dry run")
    require_unique_key(star.customers, "customer_id")
    require_unique_key(star.products, "product_id")
    started = time.perf_counter()
    clean = silver(star)
    if dry_run:
        with persisted(clean) as kept:
            yield _finish(kept, [], output, started, fmt=fmt, top_n=top_n, dry_run=True)
        return
    path = f"{output.rstrip('/')}/{views.SILVER_VIEW}"
    written = [_replaced(clean, path, fmt, SILVER_PARTITIONS)]
    stored = read_partitioned(spark, path, clean.schema, SILVER_PARTITIONS, fmt)
    if fmt == "parquet":
        for name, sums in incremental.SUMS.items():
            path = f"{output.rstrip('/')}/{name}"
            written.append(_replaced(sums.of(stored), path, fmt, (incremental.MONTH,)))
    yield _finish(stored, written, output, started, fmt=fmt, top_n=top_n, dry_run=False)


def _replaced(table: DataFrame, path: str, fmt: str, partition_by: tuple[str, ...] = ()) -> Written:
    if fmt == "parquet":
        return replace_whole(table, path, partition_by=partition_by)
    return write_table(table, path, fmt=fmt, partition_by=partition_by, dry_run=False)


def late(
    spark: SparkSession, star: Star, output: str, top_n: int = TOP_CUSTOMERS
) -> incremental.Changes:
    """Bring a late batch into the Parquet tables of an earlier run."""
    require_unique_key(star.customers, "customer_id")
    require_unique_key(star.products, "product_id")
    base = output.rstrip("/")
    changes = incremental.upsert_silver(star, f"{base}/{views.SILVER_VIEW}")
    if not changes.months:
        return changes
    maintained = {}
    for name, sums in incremental.SUMS.items():
        sums.apply(changes, f"{base}/{name}")
        schema = sums.of(changes.added).schema
        maintained[name] = sums.read(spark, f"{base}/{name}", schema)
    for name, table in incremental.gold_from_sums(maintained, top_n).items():
        stored = read_table(spark, f"{base}/{name}").schema
        replace_whole(table.select([F.col(f.name).cast(f.dataType) for f in stored]), f"{base}/{name}")
    return changes


def _stored(spark: SparkSession, path: str, fmt: str, table: DataFrame) -> DataFrame:
    if fmt == "parquet":
        return read_table(spark, path, table.schema)
    return spark.read.format(fmt).load(path)


def _finish(
    clean: DataFrame,
    written: list[Written],
    output: str | None,
    started: float,
    *,
    fmt: str,
    top_n: int,
    dry_run: bool,
) -> Result:
    """Business tables over the kept or stored clean sales; written ones are read back."""
    result = Result(clean, gold_tables(clean, top_n), written)
    result.silver_rows = clean.count()
    result.silver_seconds = time.perf_counter() - started
    for name, table in result.gold.items():
        if output:
            path = f"{output.rstrip('/')}/{name}"
            if dry_run:
                result.written.append(write_table(table, path, fmt=fmt))
            else:
                result.written.append(_replaced(table, path, fmt))
                result.gold[name] = _stored(clean.sparkSession, path, fmt, table)
    views.register({views.SILVER_VIEW: clean, **result.gold})
    return result


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder with txns and the dimensions")
    parser.add_argument("--input_format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--output", help="folder for the results")
    parser.add_argument("--format", default="parquet", help="parquet, or delta if installed")
    parser.add_argument("--top_n", type=int, default=TOP_CUSTOMERS)
    parser.add_argument("--shuffle_partitions", type=int)
    parser.add_argument("--write", action="store_true", help="write; otherwise a dry run")
    parser.add_argument("--late", action="store_true", help="bring the input into stored tables")
    args = parser.parse_args(argv)
    if args.late and not (args.write and args.output and args.format == "parquet"):
        parser.error("--late needs --write, --output and the parquet format")
    spark = build_session("tallyline-etl", shuffle_partitions=args.shuffle_partitions)
    read = read_star if args.input_format == "parquet" else read_star_csv
    started = time.perf_counter()
    if args.late:
        changes = late(spark, read(spark, args.input), args.output, args.top_n)
        print(f"months changed: {sorted(changes.months, key=str)}")
        print(f"finished in {time.perf_counter() - started:.2f} s")
        return
    with run(
        spark,
        read(spark, args.input),
        args.output,
        dry_run=not args.write,
        fmt=args.format,
        top_n=args.top_n,
    ) as result:
        print(f"clean sales: {result.silver_rows} rows in {result.silver_seconds:.2f} s")
        silver_sample(result.silver).show(truncate=False)
        for name, sample in head_reports(result.gold).items():
            print(name)
            sample.show(truncate=False)
        if args.input_format == "csv":
            for name, lines in rejected_lines(spark, args.input).items():
                print(f"{name}: {lines.count()} lines rejected")
                if args.write:
                    path = f"{args.output.rstrip('/')}/rejected_{name}"
                    result.written.append(write_table(lines, path, dry_run=False))
        for table in result.written:
            print(table)
    print(f"finished in {time.perf_counter() - started:.2f} s")


if __name__ == "__main__":
    main()
