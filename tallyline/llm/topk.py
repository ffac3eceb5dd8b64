"""Exact top-k search by integer inner product, pruned block by block.

Vectors are made integer and dealt into shards by ranges of their id. A shard is cut into
blocks; a block's forward index is its matrix of values, its summary the largest and the
smallest value of each term (dimension). For a query the sum over the terms of the larger of
(value x block maximum, value x block minimum) bounds every score in the block. Blocks are
taken in falling order of the bound and scored until the bounds fall below the k-th score
found so far; a block whose bound equals it is still scored, since a tie may have a smaller
id. The best of each shard are then merged by rank.

Queries and shards are both dealt in pieces of bounded size, and a task scores one piece of
queries against one shard, so neither side is broadcast nor held whole. Every vector meets
every piece of queries once; large pieces keep that traffic low.

Defined cases: a vector that is null or holds a null or non-finite component takes no part,
nor does a row without an id. Missing components of a shorter vector count as 0. Rows that
repeat an id and vector count once; of several vectors with one id each is a candidate and
the smallest (by array order) is the query. Values must stay below 2^26 in magnitude, for
exact 64-bit scores. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import kept, pick, ship

SCALE = 1024
SHARD_ROWS = 16_384
QUERY_ROWS = 16_384
#: Queries whose bounds a task holds at once.
BOUND_ROWS = 1_024
BLOCK_ROWS = 128
LARGEST = 2**26
#: Products of larger values would leave the range in which doubles count exactly.
EXACT_IN_DOUBLE = 2**53

HITS = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``, floor(1024 * x) of every component, of the rows that take part."""
    rows = pick(vectors, "vec_id", "embedding").where("vec_id is not null")
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(
        doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (
        rows.where(F.col("embedding").isNotNull() & finite)
        .select(
            "vec_id",
            F.transform(doubles, lambda x: F.floor(x * SCALE).try_cast("int")).alias("v"),
        )
        .distinct()
    )


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    sizes = rows.map(len).to_numpy()
    if len(rows) and (sizes == width).all():
        return np.array(rows.tolist(), np.int64)
    out = np.zeros((len(rows), width), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def _products(queries: np.ndarray, block: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products; by the fast double product where every partial sum is exact in it."""
    if exact:
        return np.rint(queries.astype(float) @ block.T.astype(float)).astype(np.int64)
    return queries @ block.T


def _sorted_for_blocks(values: np.ndarray) -> np.ndarray:
    """An order in which neighbours point the same way: by the signs of the leading terms."""
    signs = (values[:, :16] > 0).astype(np.int64)
    return np.argsort(signs @ (1 << np.arange(signs.shape[1]))[::-1], kind="stable")


def search_shard(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray,
    k: int, block_rows: int = BLOCK_ROWS,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query id, ids, scores, blocks scored) of each query's best ``k`` in a shard."""
    order = _sorted_for_blocks(values)
    ids, values = ids[order], values[order]
    starts = np.arange(0, len(ids), block_rows)
    highest = np.maximum.reduceat(values, starts)
    lowest = np.minimum.reduceat(values, starts)
    reach = int(np.abs(values).max(initial=0)) * int(np.abs(queries).max(initial=0))
    exact = reach * max(values.shape[1], 1) < EXACT_IN_DOUBLE
    for q, query_id in enumerate(query_ids):
        if q % BOUND_ROWS == 0:
            some = queries[q : q + BOUND_ROWS]
            bounds = _products(np.maximum(some, 0), highest, exact) + _products(
                np.minimum(some, 0), lowest, exact
            )
            best_first = np.argsort(-bounds, axis=1, kind="stable")
        bound, order = bounds[q % BOUND_ROWS], best_first[q % BOUND_ROWS]
        got_ids = np.empty(0, np.int64)
        got = np.empty(0, np.int64)
        scored = 0
        for step, b in enumerate(order):
            if len(got) == k and bound[b] < got[-1]:
                break
            at = slice(starts[b], starts[b] + block_rows)
            scores = _products(queries[q : q + 1], values[at], exact)[0]
            fits = ids[at] != query_id
            if len(got) == k:
                fits &= scores >= got[-1]
            scored = step + 1
            if fits.any():
                got_ids = np.concatenate([got_ids, ids[at][fits]])
                got = np.concatenate([got, scores[fits]])
                first = np.lexsort((got_ids, -got))[:k]
                got_ids, got = got_ids[first], got[first]
        yield int(query_id), got_ids, got, scored


def top_k(
    vectors: DataFrame,
    k: int = 10,
    query_step: int = 100,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows for every row whose
    id is divisible by ``query_step``, among all rows with another id."""
    spark = ship(vectors.sparkSession)
    rows = kept(integer_vectors(vectors), "vectors")
    is_query = F.col("vec_id") % query_step == 0
    size = rows.agg(
        F.count("*").alias("rows"), F.max(F.size("v")).alias("width"),
        F.count_distinct(F.when(is_query, F.col("vec_id"))).alias("queries"),
        F.max(F.exists("v", lambda x: x.isNull() | (F.abs(x) >= LARGEST))).alias("too_large"),
    ).first()
    if size.too_large:
        raise ValueError("a component beyond 65,536 does not allow exact scores")
    shards = -(-size.rows // shard_rows) or 1
    pieces = -(-size.queries // query_rows) or 1
    width = size.width or 0

    # Ranges of ids become shards: repartitionByRange samples ids, it never collects rows.
    ranged = rows.repartitionByRange(shards, "vec_id", "v").withColumn(
        "shard", F.spark_partition_id()
    )
    docs = ranged.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"), "vec_id", "v"
    )
    queries = (
        rows.where(is_query)
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))).alias("shard"),
            F.pmod(F.xxhash64("vec_id"), F.lit(pieces)).cast("int").alias("piece"),
            "vec_id", "v",
        )
    )

    def search(queries_: pd.DataFrame, docs_: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(queries_) and len(docs_):
            found = search_shard(
                queries_["vec_id"].to_numpy(), _matrix(queries_["v"], width),
                docs_["vec_id"].to_numpy(), _matrix(docs_["v"], width), k,
            )
            parts = [
                pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores})
                for query_id, ids, scores, _ in found
            ]
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(parts).astype("int64")

    keys = ("shard", "piece")
    hits = (
        queries.groupBy(*keys).cogroup(docs.groupBy(*keys)).applyInPandas(search, HITS)
    )
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
