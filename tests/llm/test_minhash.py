import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_frames import LONG, SF_DIR, documents, rows_of

from tallyline.llm import minhash
from tallyline.llm.common import pick
from tallyline.llm.queries import QUERIES


def shingles(text, words):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return frozenset()
    width = min(words, len(tokens))
    return frozenset(tuple(tokens[k : k + width]) for k in range(len(tokens) - width + 1))


def by_hand(rows, words):
    """(doc_id, n_shingles, component_id, kept) by comparing all texts that share a shingle."""
    sets = [shingles(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    seen = defaultdict(list)
    for k, own in enumerate(sets):
        shared = defaultdict(int)
        for shingle in own:
            for other in seen[shingle]:
                shared[other] += 1
            seen[shingle].append(k)
        for other, both in shared.items():
            if 100 * both >= 80 * (len(own) + len(sets[other]) - both):
                parent[find(k)] = find(other)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        name = least.get(find(k)) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), name, doc_id == name))
    return sorted(out, key=repr)


def found(spark, rows, words=4):
    got = minhash.near_duplicates(documents(spark, rows), words)
    return rows_of(got, "doc_id", "n_shingles", "component_id", "kept")


def chains(draw, base_words=60, copies=40):
    """Copies of copies: the ends of a chain are not similar, yet one component."""
    vocabulary = [f"w{k}" for k in range(5000)]
    out = []
    for _ in range(6):
        words = [draw.choice(vocabulary) for _ in range(base_words)]
        for _ in range(copies):
            out.append(" ".join(words))
            words = list(words)
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
    return out


def test_equals_brute_force_on_chains_and_odd_rows(spark):
    draw = random.Random(3)
    texts = chains(draw) + [
        "One two", "one TWO", "one two three", "É x", "é x", "", None, " \n ", LONG, LONG + "end",
        "a b c d", "a b c d", "a\x1cb c d", "a b c d",
    ]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    rows += [(5, rows[5][1]), (6, rows[7][1]), (None, rows[9][1]), (None, "nobody else says this")]
    assert found(spark, rows) == by_hand(rows, 4)


def test_a_bucket_of_many_components_is_settled(spark):
    """Near copies that no hub links to all others, beside texts that share half their words."""
    draw = random.Random(9)
    base = [f"b{k}" for k in range(80)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(80)] = f"x{draw.random()}"
        texts.append(" ".join(words))
    passage = [f"p{k}" for k in range(60)]
    texts += [" ".join(passage + [f"t{k}_{i}" for i in range(20)]) for k in range(60)]
    rows = list(enumerate(texts))
    assert found(spark, rows) == by_hand(rows, 4)


def test_query_equals_brute_force(spark):
    got = QUERIES["op5_minhash_dedup"](spark, SF_DIR)
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = by_hand([tuple(row) for row in table], 4)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == want


def test_empty(spark):
    assert found(spark, []) == []
    assert minhash.without_duplicates(documents(spark, [], clash=False)).count() == 0


def test_one_row_of_each_component_is_left(spark):
    copy = "these are the words of a text that has been copied many times by now"
    rows = [(3, copy), (1, copy), (1, copy), (9, copy + " again"), (4, ""), (4, ""), (8, None), (2, "alone here")]
    given = documents(spark, rows)
    left = minhash.without_duplicates(given)
    assert left.columns == given.columns
    assert rows_of(pick(left, "doc_id", "text"), "doc_id", "text") == sorted(
        [(1, copy), (4, ""), (4, ""), (8, None), (2, "alone here")], key=repr
    )


@pytest.mark.parametrize("similarity", [0.3, 0.8])
def test_signature_estimates_similarity_without_bias(similarity):
    draw = np.random.default_rng(1)
    minmax, agree = minhash.MinMax(), []
    for _ in range(60):
        pool = draw.integers(0, 2**63, 400, np.uint64)
        both = round(400 * similarity)
        alone = (400 - both) // 2
        a, b = pool[: both + alone], np.concatenate([pool[:both], pool[both + alone :]])
        agree.append((minmax.signature(a) == minmax.signature(b)).mean())
    assert abs(np.mean(agree) - similarity) < 0.02


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 130)]
    edges += [(200 + k, 200 + (k + 1) % 7) for k in range(7)] + [(129, 300), (300, 129)]
    got = minhash.components(spark.createDataFrame(edges, "a long, b long"))
    want = [(k, 0) for k in range(51)] + [(k, 100) for k in [*range(100, 130), 300]]
    assert rows_of(got, "node", "root") == sorted([*want, *((200 + k, 200) for k in range(7))], key=repr)
