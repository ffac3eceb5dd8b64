import math
import random

import numpy as np
import pytest
from llm_frames import rows_of

from tallyline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, piece string, v string"


def vectors(spark, rows):
    return spark.createDataFrame([(id_, v, "x", "y", "z") for id_, v in rows], SCHEMA)


def by_hand(rows, k=10, step=100):
    usable = {
        (id_, tuple(math.floor(1024 * float(np.float32(x))) for x in v))
        for id_, v in rows
        if id_ is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    queries = {}
    for id_, v in usable:
        if id_ % step == 0:
            queries[id_] = min(queries.get(id_, v), v)
    out = []
    for q, v in queries.items():
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), id_) for id_, w in usable if id_ != q]
        out += [(q, rank, id_, -score) for rank, (score, id_) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    draw = random.Random(5)
    rows = [(k, [draw.choice([-0.5, 0.25, 0.001, 1.0]) for _ in range(6)]) for k in range(700)]
    rows += [(k, [draw.gauss(0, 1) for _ in range(6)]) for k in range(700, 1400)]
    rows += [
        (None, [1.0] * 6), (2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 6),
        (2003, [float("inf")] + [0.0] * 5), (2100, []), (2004, [9.0, 9.0]), (-100, [0.1] * 6),
        (0, rows[0][1]), (5, [3.0] * 6), (5, [-3.0] * 6),
    ]
    got = topk.top_k(vectors(spark, rows), shard_rows=400, query_rows=5)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == by_hand(rows)


def test_fewer_rows_than_asked_for_and_none(spark):
    few = topk.top_k(vectors(spark, [(0, [1.0]), (1, [0.5]), (2, [0.5])]))
    assert rows_of(few, "vec_id", "rank", "score") == [(1, 1, 1024 * 512), (2, 2, 1024 * 512)]
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(0, [1.0])])).count() == 0


def test_blocks_are_skipped():
    values = np.zeros((4096, 8), np.int64)
    values[np.arange(4096), np.arange(4096) // 512] = 1000
    ((_, ids, scores, scored),) = topk.search_shard(
        np.array([-1]), values[:1] * 3, np.arange(4096), values, 10
    )
    assert scored < 4096 / topk.BLOCK_ROWS / 2
    assert ids.tolist() == [*range(10)] and set(scores) == {3_000_000}


def test_too_large_components_are_refused(spark):
    for value in (65_536.0, -1e30):
        with pytest.raises(ValueError, match="exact"):
            topk.top_k(vectors(spark, [(0, [1.0]), (1, [value])]))


def test_bounds_hold_over_many_queries(monkeypatch):
    draw = np.random.default_rng(0)
    values = draw.integers(-50, 50, (600, 5))
    whole = [(q, ids.tolist(), scores.tolist()) for q, ids, scores, _ in topk.search_shard(np.arange(90), values[:90], np.arange(600), values, 4)]
    monkeypatch.setattr(topk, "BOUND_ROWS", 7)
    parts = [(q, ids.tolist(), scores.tolist()) for q, ids, scores, _ in topk.search_shard(np.arange(90), values[:90], np.arange(600), values, 4)]
    assert whole == parts
