"""Write synthetic tables: ``python -m tallyline.jobs.generate --base DIR --write``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tallyline.generate import ROWS_PER_TASK, ids, keyed, star, states
from tallyline.operators.layout import tasks_for
from tallyline.session import build_session
from tallyline.sinks.tables import Written, write_by_month, write_csv, write_table
from tallyline.sources.tables import Star, star_paths

#: Fewest files of the transactions; more rows get more files.
LEAST_FILES = 16


def star_frames(
    spark: SparkSession,
    n_customers: int = 50_000,
    n_products: int = 5_000,
    n_txns: int = 1_000_000,
    partitions: int | None = None,
    seed: int = star.SEED,
) -> Star:
    return Star(
        star.transactions(ids(spark, n_txns, partitions), n_customers, n_products, seed),
        star.customers(ids(spark, n_customers, partitions), seed),
        star.products(ids(spark, n_products, partitions), seed),
    )


def keyed_frames(
    spark: SparkSession,
    n_customers: int = 10_000,
    n_products: int = 3_000,
    n_txns: int = 200_000,
    partitions: int | None = None,
    seed: int = star.SEED,
) -> dict[str, DataFrame]:
    return {
        "customers": keyed.customers(ids(spark, n_customers, partitions), seed),
        "products": keyed.products(ids(spark, n_products, partitions), seed),
        "transactions": keyed.transactions(
            ids(spark, n_txns, partitions), n_customers, n_products, seed
        ),
    }


def state_frames(
    spark: SparkSession, n_sales: int = 500_000, partitions: int | None = None
) -> dict[str, DataFrame]:
    return {
        "sales": states.state_sales(ids(spark, n_sales, partitions)),
        "state_category": states.state_categories(ids(spark, states.CATEGORY_ROWS, 1)),
    }


def write_star(tables: Star, base: str, *, dry_run: bool = True) -> list[Written]:
    """Transactions in year/month folders, dimensions whole.

    A task has rows for the few months of the generated span, so nothing is shuffled.
    """
    paths = star_paths(base)
    return [
        write_by_month(tables.txns, paths["txns"], grouped=False, dry_run=dry_run),
        write_table(tables.customers, paths["customers"], dry_run=dry_run),
        write_table(tables.products, paths["products"], dry_run=dry_run),
    ]


def write_star_csv(tables: Star, base: str, *, dry_run: bool = True) -> list[Written]:
    """The star as raw CSV folders."""
    return [
        write_csv(getattr(tables, name), path, dry_run=dry_run)
        for name, path in star_paths(base).items()
    ]


def write_keyed(
    tables: dict[str, DataFrame],
    base: str,
    files: int = LEAST_FILES,
    *,
    dry_run: bool = True,
) -> list[Written]:
    """``files`` is the number of files of the transactions, see ``keyed_files``."""
    return [
        write_table(
            frame,
            f"{base}/{name}",
            files=files if name == "transactions" else None,
            dry_run=dry_run,
        )
        for name, frame in tables.items()
    ]


def keyed_files(n_txns: int) -> int:
    return tasks_for(n_txns, LEAST_FILES, ROWS_PER_TASK)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--base", required=True, help="folder that will hold the tables")
    parser.add_argument("--family", choices=("star", "keyed"), default="star")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--num_customers", type=int, default=50_000)
    parser.add_argument("--num_products", type=int, default=5_000)
    parser.add_argument("--num_txns", type=int, default=1_000_000)
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--write", action="store_true", help="write; otherwise a dry run")
    args = parser.parse_args(argv)
    if args.family == "keyed" and args.format == "csv":
        parser.error("the keyed tables are written as parquet only")
    spark = build_session("tallyline-generate")
    sizes = (args.num_customers, args.num_products, args.num_txns, args.partitions)
    if args.family == "star":
        write = write_star if args.format == "parquet" else write_star_csv
        done = write(star_frames(spark, *sizes), args.base, dry_run=not args.write)
    else:
        done = write_keyed(
            keyed_frames(spark, *sizes),
            args.base,
            keyed_files(args.num_txns),
            dry_run=not args.write,
        )
    for table in done:
        print(table)


if __name__ == "__main__":
    main()
