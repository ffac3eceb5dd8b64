"""Mixing: against a plain re-computation that sorts every source."""

import hashlib
from fractions import Fraction

import pytest
from llm_frames import ODD_TEXTS, documents, rows_of

from tallyline.llm import mixing
from tallyline.llm.common import kept


def words(text):
    return len([w for w in __import__("re").split(r"[ \t-\r]+", text or "") if w])


def hash_of(doc_id, text):
    joined = f"{'' if doc_id is None else doc_id}|{text or ''}"
    return int(hashlib.md5(joined.encode()).hexdigest()[:15], 16)


def plain_targets(sizes, weights=(5, 2, 1)):
    """Shares by weight, what exceeds twice a source's size shared anew, in fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {source: weights[k % len(weights)] for k, source in enumerate(order)}
    left, open_, target = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * unit >= 2 * sizes[s]}
        if not above:
            target |= {s: weight[s] * unit for s in open_}
            break
        for source in above:
            target[source] = Fraction(2 * sizes[source])
            left -= 2 * sizes[source]
        open_ -= above
    return target


def plain_mix(rows, bucket_rows):
    """Sorted (doc_id, size, source_size, target, taken)."""
    by_source = {}
    for doc_id, text, source in rows:
        by_source.setdefault(source, []).append((hash_of(doc_id, text), words(text), doc_id))
    sizes = {source: sum(size for _, size, _ in docs) for source, docs in by_source.items()}
    target = plain_targets(sizes)
    out = []
    for source, docs in by_source.items():
        size_all, whole, left = sizes[source], 0, 0
        if size_all:
            whole, left = divmod(int(target[source]), size_all)
        docs.sort(key=lambda doc: doc[:2])
        lo, hi, bits = 0, len(docs) if left else 0, mixing.HASH_BITS
        while left and hi - lo > bucket_rows and bits:
            bits -= mixing.LEVEL_BITS
            upto = left
            buckets = {}
            for k in range(lo, hi):
                buckets.setdefault(docs[k][0] >> bits, []).append(k)
            for places in buckets.values():
                size = sum(docs[k][1] for k in places)
                if upto - size < 0:
                    lo, hi, left = places[0], places[-1] + 1, upto
                    break
                upto -= size
        for k, (_, size, doc_id) in enumerate(docs):
            extra = k < lo
            if lo <= k < hi and size <= left:
                extra, left = True, left - size
            out.append((doc_id, size, size_all, float(target[source]), size * (whole + extra)))
    return sorted(out, key=repr)


def sourced(spark, rows):
    schema = "doc_id long, text string, source string, copies int, TARGET string, of string"
    return spark.createDataFrame([(*row, 7, "x", "y") for row in rows], schema)


def mixed(spark, rows, bucket_rows=mixing.BUCKET_ROWS):
    measured = kept(mixing.measured(sourced(spark, rows)), "measured")
    out = mixing.mix(measured, bucket_rows=bucket_rows)
    taken = [
        (r.doc_id, r.size, r.source_size, r.target, r.size * r.copies) for r in out.collect()
    ]
    return sorted(taken, key=repr)


CORPUS = [
    (k, "w " * (1 + k * k % 37), f"s{min(k % 11, 4)}" if k % 29 else None) for k in range(2_000)
]


@pytest.mark.parametrize("bucket_rows", [4, 100, mixing.BUCKET_ROWS])
def test_like_a_sort(spark, bucket_rows):
    got = mixed(spark, CORPUS, bucket_rows)
    assert got == plain_mix(CORPUS, bucket_rows)
    taken, aim, size = {}, {}, {}
    for doc_id, doc_size, source_size, target, words_taken in got:
        key = source_size
        taken[key] = taken.get(key, 0) + words_taken
        aim[key], size[key] = target, source_size
        assert words_taken <= 2 * doc_size
    assert all(0 <= aim[key] - taken[key] < 60 for key in aim)


def test_equal_rows_are_split(spark):
    """A source of one repeated row, and one in which that row is a third."""
    rows = [(1, "a b c", "x")] * 900 + [(k, "a b c d", "y") for k in range(1_800)] + [(5, "e f", "y")] * 900
    got = mixed(spark, rows, bucket_rows=50)
    assert got == plain_mix(rows, 50)
    assert len({row[4] for row in got if row[0] == 1}) <= 2


def test_order_and_partitions_do_not_matter(spark):
    again = list(reversed(CORPUS))
    measured = kept(mixing.measured(sourced(spark, again).repartition(13)), "measured")
    out = mixing.mix(measured, bucket_rows=16)
    got = sorted(((r.doc_id, r.size * r.copies) for r in out.collect()), key=repr)
    assert got == sorted(((r[0], r[4]) for r in plain_mix(CORPUS, 16)), key=repr)


def test_odd_rows(spark):
    rows = [(k, text, source) for k, (_, text) in enumerate(ODD_TEXTS) for source in ("", None, "É", "z")]
    rows += [(None, None, "void"), (None, "", "void"), (3, " \t", "void")] * 400
    assert mixed(spark, rows) == plain_mix(rows, mixing.BUCKET_ROWS)
    assert mixed(spark, []) == []
    assert mixed(spark, [(1, None, None)]) == [(1, 0, 0, 0.0, 0)]


def test_documents_come_as_often_as_taken(spark):
    frame = documents(spark, [(k, "w " * (k + 1), "en") for k in range(40)])
    got = rows_of(mixing.mixed_documents(frame), "doc_id", "copy")
    # One source: half of its words once more than the rest.
    assert {copy for _, copy in got} == {1, 2}
    assert len([row for row in got if row[1] == 1]) == 40
    extra = sum(k + 1 for k, copy in got if copy == 2)
    assert 0 <= 410 - extra <= 5
