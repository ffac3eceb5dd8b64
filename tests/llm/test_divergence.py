"""Divergence: arrays against dictionaries, the audit against a plain re-computation."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import LONG, rows_of

from tallyline.llm import divergence

sorted_ids = st.lists(st.integers(1, 3_000), unique=True, max_size=900).map(sorted)


def arrays(ids, salt):
    return np.array(ids, np.int64), np.array([1 + (i * salt) % 7 for i in ids], np.int64)


@settings(max_examples=60, deadline=None)
@given(sorted_ids, sorted_ids)
def test_gallop_finds_what_is_there(short, long):
    at = divergence.gallop(np.array(short, np.int64), np.array(long, np.int64))
    assert at.tolist() == [long.index(x) if x in set(long) else -1 for x in short]


@settings(max_examples=60, deadline=None)
@given(sorted_ids, sorted_ids)
def test_merge_prices_both_ways(one, other):
    totals = (10_000, 77_777)
    left, right = arrays(one, 3), arrays(other, 5)
    counts = [dict(zip(*map(np.ndarray.tolist, side), strict=True)) for side in (left, right)]
    there = back = 0
    for term in set(one) | set(other):
        p, q = (
            1 + 10**9 * (side.get(term, 0) + 1) // total
            for side, total in zip(counts, totals, strict=True)
        )
        there, back = there + (p - q) ** 2 // q, back + (q - p) ** 2 // p
    assert divergence.merge(left, right, totals) == (there, back, len(set(one) | set(other)))


@given(st.integers(0, 10**14), st.integers(1, 9 * 10**15))
def test_shares_are_exact(count, total):
    count = min(count, total - 1)
    assert divergence.shares(np.array([count]), total)[0] == 1 + 10**9 * (count + 1) // total


def plain_audit(rows, top_terms=200, min_documents=3):
    term = re.compile(divergence.TERM)
    lower = {c: c + 32 for c in range(65, 91)}
    counts, docs, groups = defaultdict(Counter), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = term.findall((text or "").translate(lower))
        counts[lang, source].update(found)
        docs.update((lang, word) for word in set(found))
    out = []
    for lang, source in groups:
        used = [word for (of, word), n in docs.items() if of == lang and n >= min_documents]
        whole = Counter()
        for key in groups:
            if key[0] == lang:
                whole.update(counts[key])

        def shares(counter, used=used):
            total = sum(counter[w] for w in used) + len(used)
            return {w: 1 + 10**9 * (counter[w] + 1) // total for w in used}

        p, base = shares(counts[lang, source]), shares(whole)
        pairs = []
        for other in (s for of, s in groups if of == lang and s != source):
            q = shares(counts[lang, other])
            pairs.append((other, sum((p[w] - q[w]) ** 2 // q[w] for w in used)))
        terms = [
            (w, (p[w] - base[w]) ** 2 // base[w])
            for w in used
            if counts[lang, source][w] and p[w] > base[w]
        ]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda item: (-item[1], item[0].encode()))
            for rank, (item, value) in enumerate(items, 1):
                if part == "pair" or rank <= top_terms:
                    out.append((lang, source, part, item, value, rank))
    return sorted(out, key=repr)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")
ROWS = [
    (" ".join(f"w{chr(97 + (k * j) % 26)}{chr(97 + j % 13)} É{j % 5}a" for j in range(30)), lang, f"s{k % 5}")
    for k in range(60)
    for lang in ("en", "fr")
] + [
    (None, "en", "s9"), ("", None, None), ("Only NUMBERS 12", None, "x"), (LONG, "en", None),
    ("naïve café — 日本語 😀 \x00 ABC", "de", "a"), ("ABC abc", "de", "b"), ("abc", "de", "b"),
    ("abc", "de", "b"), (None, "it", "only"),
]


def frame(spark, rows):
    schema = "text string, lang string, source string, TERM string, count string, block int, docs int"
    return spark.createDataFrame([(*row, "x", "y", 1, 2) for row in rows], schema)


@pytest.mark.parametrize("block_terms", [divergence.BLOCK_TERMS, 20])
def test_like_a_plain_audit(spark, monkeypatch, block_terms):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    got = rows_of(divergence.audit(frame(spark, ROWS), top_terms=9), *COLUMNS)
    assert got == plain_audit(ROWS, top_terms=9)


def test_empty(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    few = [("a b", "en", "x"), (None, "en", "y"), ("a", None, "y")]
    got = rows_of(divergence.audit(frame(spark, few)), *COLUMNS)
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def batch(rows):
    names = ["text", "lang", "source"]
    columns = zip(*rows, strict=True)
    types = (pa.binary(), pa.string(), pa.string())
    arrays = [pa.array(c, kind) for c, kind in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def test_a_worker_sums_many_terms(monkeypatch):
    """Each term of a group leaves a worker once, however many there are, until the bytes are many."""
    text = " ".join(f"{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}{chr(97 + d)}" for a in range(26)
                    for b in range(26) for c in range(26) for d in range(26)).encode()
    rows = [(text + b" aaaa AAAA", "en", "x"), (b"", "fr", ""), (text, "en", "x"), (b" aaaa\xc3\xa9.", "en", "y")]

    def found():
        parts = divergence._counted(iter([batch(rows[:2]), batch(rows[2:]).slice(0), batch(rows[2:]).slice(1)]))
        return [row for part in parts for row in part.to_pylist()]

    got = found()
    assert len(got) == 26**4 + 1 + 3
    keyed = {(row["lang"], row["source"], row["term"]): (row["count"], row["docs"]) for row in got}
    assert keyed["en", "x", b"aaaa"] == (4, 2) and keyed["en", "x", b"zzzz"] == (2, 2)
    assert keyed["en", "y", "aaaaé".encode()] == (2, 2)
    assert keyed["fr", "", b""] == keyed["en", "x", b""] == (0, 0)
    monkeypatch.setattr(divergence, "HELD_BYTES", 1)
    apart = Counter()
    for row in found():
        apart[row["lang"], row["source"], row["term"]] += row["count"]
    assert apart == Counter({key: count for key, (count, _) in keyed.items()})


def test_terms_are_shuffled_once_before_they_are_numbered(spark):
    counted = divergence.numbered(divergence.term_counts(frame(spark, ROWS)), 3)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1
    ids = counted.where("term <> ''").select("lang", "term", "id").distinct().collect()
    assert len({(r.lang, r.id) for r in ids}) == len({(r.lang, r.term) for r in ids}) == len(ids) > 40
    heads = counted.where("head").select("lang", "term").collect()
    assert len(heads) == len(set(heads)) == counted.select("lang", "term").distinct().count()
