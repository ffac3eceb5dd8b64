"""Collocations: the parse against plain windows, the result against a plain re-computation."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import LONG, rows_of

from tallyline.llm import collocations


def windows(words, most=3):
    return [
        " ".join(words[i : i + k])
        for k in range(1, most + 1)
        for i in range(len(words) - k + 1)
    ]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from([*"abcdefgh", "\n"]), min_size=1, max_size=90),
    st.sampled_from([2, 12, 1_024]),
    st.sampled_from([3, 32]),
)
def test_chunks_hold_each_phrase_once(tokens, longest, modulus):
    before = collocations.LONGEST, collocations.MODULUS
    collocations.LONGEST, collocations.MODULUS = longest, modulus
    try:
        closed, last = collocations.chunks_of([t.encode() for t in tokens], collocations._Hashes())
    finally:
        collocations.LONGEST, collocations.MODULUS = before
    wanted = Counter()
    for piece in " ".join(tokens).split("\n"):
        wanted.update(windows(piece.split()))
    found = Counter()
    for length in (1, 2, 3):
        held = collocations._Phrases(length, None)
        held.add("x", [*closed, last], np.array([True] * len(closed) + [False]), np.ones(len(closed) + 1, np.int64))
        for batch in held.release():
            for phrase, freq in zip(batch["phrase"].to_pylist(), batch["freq"].to_pylist(), strict=True):
                found[phrase.decode()] += freq
    assert found == wanted
    assert all(chunk.count(b" ") < longest + 2 for chunk in [*closed, last]) or longest == 2


def test_tokens_keep_words_and_ends():
    text = "  A.b\t. \n\nC d,,\x0be\xa0f É! ".encode()
    assert collocations.tokens_of(text) == [
        b"a", b"\n", b"b", b"\n", b"c", b"d", b"\n", "e\xa0f".encode(), "É".encode()
    ]
    assert collocations.tokens_of(b" \t\n.,") == []


def test_repeats_do_not_cut_everywhere():
    closed, last = collocations.chunks_of([b"na"] * 5_000, collocations._Hashes())
    assert len(closed) < 10 or len(closed) > 4_900  # the pair cuts or does not, by its hash
    words = [b"w%d" % (k % 977) for k in range(20_000)]
    closed, _ = collocations.chunks_of(words, collocations._Hashes())
    assert 20_000 / 60 < len(closed) < 20_000 / 18


def test_equal_passages_give_equal_chunks():
    passage = [b"w%d" % (k * 7919 % 1009) for k in range(900)]
    hashes = collocations._Hashes()
    one, _ = collocations.chunks_of([b"x"] + passage, hashes)
    other, _ = collocations.chunks_of([b"y", b"z"] + passage + [b"q"], hashes)
    assert len(set(one) & set(other)) >= len(one) - 2 > 8


def plain(rows, min_count=10, best=2_000):
    lower = {c: c + 32 for c in range(65, 91)}
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            counts[lang or "und" if lang is None else lang].update(
                windows(re.findall(r"[^\x20\x09]+", piece))
            )
    out = []
    for lang, f in counts.items():
        n = sum(c for phrase, c in f.items() if " " not in phrase)
        found = {p: a for p, a in f.items() if " " in p and a >= min_count}
        covers = Counter()
        for phrase, a in found.items():
            parts = phrase.split(" ")
            if len(parts) == 3:
                for inner in (" ".join(parts[:2]), " ".join(parts[1:])):
                    covers[inner] = max(covers[inner], a)
        scored = []
        for phrase, a in found.items():
            if 100 * covers[phrase] >= 50 * a:
                continue
            parts, cuts = phrase.split(" "), []
            for k in range(1, len(parts)):
                l, r = f[" ".join(parts[:k])], f[" ".join(parts[k:])]
                cuts.append((10**6 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            scored.append((-score, -a, phrase.encode(), phrase, l, r))
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase, -a, l, r, n, -score))
    return sorted(out, key=repr)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def text(k):
    return ". ".join(
        " ".join(f"W{(k * 7 + i * j) % 9}" for j in range(12)) + ("; New York City\tis big" if i % 2 else "\n")
        for i in range(6)
    )


ROWS = (
    [(text(k), ("en", "fr", None)[k % 3]) for k in range(60)]
    + [("the same old passage again, and again", "en")] * 40
    + [(None, "en"), ("", None), (" \t ", "de"), (LONG, "la"), ("a a a a a a a a a a a a a", "aa")]
    + [("é\x00 日本 x\xa0y.z", "u")] * 12
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(*row, "x", 1, "y") for row in rows], "text string, lang string, chunk string, freq int, LANG2 string"
    )


@pytest.mark.parametrize("best", [2_000, 7])
def test_like_plain_counting(spark, best):
    got = rows_of(collocations.collocations(frame(spark, ROWS), rows=best), *COLUMNS)
    assert got == plain(ROWS, best=best)


def test_small_holds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LONGEST", 5)
    monkeypatch.setattr(collocations, "FREQUENT_BYTES", 0)
    got = rows_of(collocations.collocations(frame(spark, ROWS), min_count=12), *COLUMNS)
    assert got == plain(ROWS, min_count=12)


def test_empty(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(None, None), ("once only", "en")])).count() == 0
    one_word = frame(spark, [("word", "en")] * 12).coalesce(1)
    assert collocations.collocations(one_word).count() == 0


def test_filter_holds_what_was_put_in(spark):
    rows = [("en", 2, f"a{k} b{k % 7}", 12) for k in range(4_000)]
    put = spark.createDataFrame(rows, "lang string, words int, phrase string, freq long")
    made = collocations.filter_of(put, 2)
    hits, lang = 0, collocations._lang_hash("en")
    for word, other in [(f"a{k}", f"b{k % 7}") for k in range(0, 4_000, 40)]:
        words = np.array([xxhash.xxh64_intdigest(w.encode()) for w in (word, other)], np.uint64)
        hashes = collocations.phrase_hashes(words, lang, 2)
        assert made.holds(hashes).tolist() == [True]
        hits += made.holds(hashes + np.uint64(12345)).sum()
    assert hits <= 10
