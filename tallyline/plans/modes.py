"""One join-and-count job under three physical settings.

``baseline``  sort-merge joins;
``broadcast`` dimensions broadcast when measured small;
``full``      the same, spread by region and size, and kept for several uses.

All modes read the same inputs and give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.joins import join_dimensions
from tallyline.operators.layout import persisted, spread_by_keys

MODES = ("baseline", "broadcast", "full")
STRATEGY = {"baseline": "merge", "broadcast": "broadcast", "full": "broadcast"}


@contextmanager
def joined(
    mode: str,
    facts: DataFrame,
    dimensions: Sequence[tuple[str, DataFrame]],
    columns: Sequence[str],
    partitions: int | None = None,
    row_key: Sequence[str] = ("txn_id",),
    keep: bool = True,
) -> Iterator[DataFrame]:
    """Facts inner-joined with their dimensions, laid out as ``mode`` says.

    Only ``columns`` are moved and kept, the ones the caller will read. Without a number of
    ``partitions`` adaptive execution takes one from the size of the data and splits what is
    too large; with one, ``row_key`` spreads a hot region. ``keep`` is for several uses of
    the frame; read once, keeping it would only cost.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    joined_rows = join_dimensions(facts, dimensions, how="inner", strategy=STRATEGY[mode])
    if mode != "full":
        yield joined_rows.select(*columns)
        return
    if partitions is None:
        spread = joined_rows.select(*columns).hint("rebalance", F.col("region"))
    else:
        moved = joined_rows.select(*dict.fromkeys([*columns, *row_key]))
        spread = spread_by_keys(
            moved, partitions, "region", spread=partitions, row_key=row_key
        ).select(*columns)
    if not keep:
        yield spread
        return
    with persisted(spread) as kept:
        yield kept
