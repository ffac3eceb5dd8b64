"""Mixing sources to target weights by hash thresholds.

Every row has a hash. Of each source the rows below a threshold are taken once more than the
others, so the budget of a source is a point on the line of hashes. Sizes are summed by source
and hash bucket; the bucket in which the budget runs out is the boundary, and only its rows are
summed again by finer buckets, until few rows are left. Those are taken in the order of their
hashes as long as they fit. The choice is then a comparison row by row: nothing is sorted, a
smaller budget takes a subset of whole buckets of a larger one, and a hot source is summed where
its rows are.

Targets: sources in code point order, null last, have weights that repeat. They share a part of
all sizes by weight; none may get more than ``most`` times its size, and what it cannot take is
shared anew by weight (a water level, found by one running sum over the sources).

Defined cases: a null text has size 0; a source of size 0 has target 0; equal rows have one hash,
of which as many are taken as fit; null and empty sources are two sources; an empty table gives an
empty result. The plan has one row for each source, and its windows see those rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import kept, pick, ship
from tallyline.operators.joins import broadcast_if_small

#: Words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: The weights of the sources in order, repeating, the percentage of all sizes that
#: is shared, and how often a source may be taken whole.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST = 2

#: Bits of a hash, bits of a level of buckets, and the rows of a bucket that is not refined.
HASH_BITS = 60
LEVEL_BITS = 6
LEVELS = HASH_BITS // LEVEL_BITS
BUCKET_ROWS = 1_024

#: Exact integers beyond 64 bits.
BIG = "decimal(38,0)"

#: Bytes of a plan up to which it is broadcast; a larger one is joined by shuffle.
PLAN_BYTES = 16 * 1024 * 1024


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(*columns: Column) -> Column:
    """A hash of 60 bits: the first 15 hex digits of the md5 of the values, null as empty."""
    values = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("long")


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, source, size and hash of every document, without its text."""
    docs = pick(documents, "doc_id", "text", "source")
    return docs.select(
        "doc_id", "source", words(F.col("text")).alias("size"),
        place(F.col("doc_id"), F.col("text")).alias("hash"),
    )


def targets(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most: int = MOST,
) -> DataFrame:
    """source, source_size, n (rows), target, whole (how often all of it is taken) and budget
    (the words beyond that) of each source. All comparisons are of integers."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by_turn = F.array(*[F.lit(weight) for weight in weights])
    weighed = sizes.select(
        "*",
        F.element_at(by_turn, (turn % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        F.col("source_size").cast(BIG).alias("exact"),
    )
    # A source fills up before another if its size for each unit of weight is smaller.
    filling = Window.orderBy(
        F.expr(f"exact * ({lcm(*weights)} div weight)"), F.col("source").asc_nulls_last()
    )
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = weighed.select(
        "*",
        F.row_number().over(filling).alias("turn"),
        (
            F.sum("exact").over(every) * share_percent
            - F.coalesce(F.sum("exact").over(earlier), F.lit(0)) * (100 * most)
        ).cast(BIG).alias("left"),
        (
            F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
        ).cast(BIG).alias("sharing"),
    )
    full = F.col("exact") * (100 * most) * F.col("sharing") <= F.col("weight") * F.col("left")
    # The first source that does not fill up sets the level of all that do not.
    first = F.min(F.when(~F.col("full"), F.struct("turn", "left", "sharing"))).over(every)
    marked = level.withColumn("full", full).withColumn("first", first)
    share = F.expr(f"CAST(weight * first.left AS {BIG})")
    unit = F.expr(f"CAST(100 * first.sharing AS {BIG})")
    shared = marked.select(
        "source", "source_size", "n", "full", share.alias("share"), unit.alias("unit")
    )
    return shared.select(
        "source",
        "source_size",
        "n",
        F.when(F.col("full"), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("share").cast("double") / F.col("unit").cast("double"))
        .alias("target"),
        F.when(F.col("full"), most * F.col("source_size"))
        .otherwise(F.expr("share div unit"))
        .alias("words"),
    ).select(
        "source", "source_size", "n", "target",
        F.coalesce(F.expr("words div nullif(source_size, 0)"), F.lit(0)).alias("whole"),
        F.coalesce(F.expr("words % nullif(source_size, 0)"), F.lit(0)).alias("budget"),
    )


def _bucket(depth: Column | int) -> Column:
    bits = F.lit(HASH_BITS) - F.lit(LEVEL_BITS) * depth
    return F.call_function("shiftright", F.col("hash"), bits.cast("int"))


def _same_source(left: DataFrame, right: DataFrame, *conditions: Column, how: str = "inner"):
    """Joined by source, null with null; the right side's source is called ``of``."""
    (small,) = broadcast_if_small(right.withColumnRenamed("source", "of"), limit=PLAN_BYTES)
    condition = F.col("source").eqNullSafe(F.col("of"))
    for further in conditions:
        condition = condition & further
    return left.join(small, condition, how)


def boundaries(rows: DataFrame, plan: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """source, depth, bucket, budget (what is left for the bucket), n (its rows) of each source.

    Buckets below ``bucket`` of that depth are taken, those above are not. One pass over the
    rows for each level, over ever fewer rows; ten levels tell all hashes apart. A source
    without a budget has a bucket that no row lies in.
    """
    nothing = F.col("budget") == 0
    state = plan.select(
        "source",
        F.when(nothing, LEVELS).otherwise(0).alias("depth"),
        F.when(nothing, -1).otherwise(0).cast("long").alias("bucket"),
        "budget",
        "n",
    )
    for depth in range(LEVELS):
        open_now = (F.col("depth") == depth) & (F.col("n") > bucket_rows)
        if state.where(open_now).isEmpty():
            break
        inside = _same_source(
            rows.select("source", "hash", "size"),
            state.where(open_now).select("source", "bucket", "budget"),
            _bucket(depth) == F.col("bucket"),
        )
        rows = kept(inside.select("source", "hash", "size", "budget"), "boundary")
        summed = rows.groupBy("source", "budget", _bucket(depth + 1).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        )
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        crossing = F.row_number().over(Window.partitionBy("source").orderBy("bucket"))
        finer = (
            summed.withColumn("upto", upto)
            .where(F.col("upto") > F.col("budget"))
            .withColumn("crossing", crossing)
            .where(F.col("crossing") == 1)
            .select(
                "source", F.lit(depth + 1).alias("depth"), "bucket",
                (F.col("budget") - (F.col("upto") - F.col("size"))).alias("budget"), "n",
            )
        )
        state = kept(state.where(~open_now).unionByName(finer), "boundaries")
    return state


def _fitting(group: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket's hashes, in order, as many rows each as still fit."""
    group = group.sort_values(["hash", "size"], kind="stable")
    left, taken = int(group["budget"].iloc[0]), []
    for size, rows in zip(group["size"].tolist(), group["n"].tolist(), strict=True):
        fits = min(rows, left // size) if size else rows
        left -= fits * size
        taken.append(fits)
    return group.assign(taken=taken)[["source", "hash", "size", "n", "taken"]]


_FITTING = "source string, hash long, size long, n long, taken long"


def _numbered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of the groups (source, hash, size) with ``number``, from 1 in each group.

    A group may be a large part of all rows: it is numbered part by part, and every part starts
    where those before it end.
    """
    inside = _same_source(rows, groups, F.col("hash") == F.col("h"), F.col("size") == F.col("s"))
    parts = kept(inside.withColumn("part", F.spark_partition_id()), "tied")
    key = ["of", "h", "s"]
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select(
        F.col("of").alias("o"), F.col("h").alias("p"), F.col("s").alias("q"),
        F.col("part").alias("start_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
    )
    (starts,) = broadcast_if_small(starts, limit=PLAN_BYTES)
    joined = parts.join(
        starts,
        F.col("of").eqNullSafe(F.col("o"))
        & (F.col("h") == F.col("p"))
        & (F.col("s") == F.col("q"))
        & (F.col("part") == F.col("start_part")),
    )
    within = F.row_number().over(Window.partitionBy(*key, "part").orderBy("hash"))
    return joined.withColumn("number", F.col("start") + within).drop("o", "p", "q", "start_part")


def mix(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most: int = MOST,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows (source, size, hash and any others, as ``measured`` gives them) with source_size,
    target, and copies: how often the mix takes the row.

    The rows are read several times, so they should be a stored table.
    """
    columns = rows.columns
    plan = kept(targets(rows, weights, share_percent, most), "targets")
    found = kept(boundaries(rows, plan, bucket_rows), "boundaries")
    plan = plan.drop("n", "budget").join(
        found.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    plan = kept(plan.drop("of"), "plan")

    buckets = plan.select("source", "depth", "bucket", "budget")
    at_boundary = _same_source(
        rows.select("source", "hash", "size"), buckets, _bucket(F.col("depth")) == F.col("bucket")
    )
    ship(rows.sparkSession)
    fitting = kept(
        at_boundary.groupBy("source", "hash", "size", "budget")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("source")
        .applyInPandas(_fitting, _FITTING),
        "fitting",
    )
    chosen = fitting.select(
        "source", F.col("hash").alias("h"), F.col("size").alias("s"), "n", "taken"
    )

    planned = _same_source(rows, plan)
    below = _bucket(F.col("depth")) < F.col("bucket")
    inside = _bucket(F.col("depth")) == F.col("bucket")
    outcome = [*columns, "source_size", "target"]
    outer = planned.where(~inside).select(
        *outcome, (F.col("whole") + below.cast("long")).alias("copies")
    )
    inner = planned.where(inside).drop("of", "n", "budget")
    all_or_none = _same_source(
        inner,
        chosen.where("taken in (0, n)"),
        F.col("hash") == F.col("h"),
        F.col("size") == F.col("s"),
    ).select(*outcome, (F.col("whole") + (F.col("taken") > 0).cast("long")).alias("copies"))
    mixed = outer.unionByName(all_or_none)
    some = chosen.where("taken not in (0, n)")
    if not some.isEmpty():
        numbered = _numbered(inner, some.drop("n"))
        mixed = mixed.unionByName(
            numbered.select(
                *outcome,
                (F.col("whole") + (F.col("number") <= F.col("taken")).cast("long")).alias("copies"),
            )
        )
    return mixed


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """doc_id, source and text of the mix, a document as often as it is taken."""
    docs = pick(documents, "doc_id", "source", "text").select(
        "*", words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("hash")
    )
    taken = mix(kept(docs, "sized"), **options).where(F.col("copies") > 0)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return taken.select("doc_id", "source", "text", copy)
