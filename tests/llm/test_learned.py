"""Classifiers: held-out accuracy, what they may learn from, and odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_frames import LONG, ODD_TEXTS, documents, labels, rows_of
from pyspark.sql import functions as F

from tallyline.llm import langid, learning, nbsvm, quality, toxicity
from tallyline.llm.common import remainder
from tallyline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels")}


@pytest.mark.parametrize(
    "name, label, modulus, held, accuracy",
    [
        ("op3_toxicity", "toxic", 5, 0, 0.95),
        ("op10_quality_classifier", "quality", 3, 1, 0.97),
        ("op8_language_id", "lang", 5, 0, 0.98),
    ],
)
def test_held_out_accuracy(spark, tables, name, label, modulus, held, accuracy):
    got = QUERIES[name](spark, SF).collect()
    source = tables["documents" if label == "lang" else "labels"]
    truth = {row.doc_id: row[label] for row in source.collect()}
    assert len(got) == tables["documents"].count()
    assert all(row.held_out == (crc(row.doc_id) % modulus == held) for row in got)
    assert all(0 <= row.score <= 1 for row in got)
    predicted = "lang_pred" if label == "lang" else "predicted"
    right = [row[predicted] == truth[row.doc_id] for row in got if row.held_out and row.doc_id in truth]
    assert len(right) > 50 and np.mean(right) >= accuracy
    if label != "lang":
        assert all(row.predicted == (row.score >= 0.5) for row in got)


def test_remainder_is_that_of_the_id_as_text(spark):
    rows = spark.range(-50, 200).select("id", remainder("id", 5).alias("r")).collect()
    assert all(row.r == crc(row.id) % 5 for row in rows)


def test_held_out_labels_are_never_learned(spark, tables):
    flipped = tables["labels"].withColumns(
        {
            "quality": F.when(remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")),
            "toxic": F.when(remainder("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")),
        }
    )
    docs = tables["documents"]
    moved = docs.withColumn("lang", F.when(remainder("doc_id", 5) == 0, "xx").otherwise(F.col("lang")))
    for build, scored in (
        (lambda d, t: nbsvm.train(d, t, remainder("doc_id", 3) != 1), nbsvm.score_quality),
        (lambda d, t: toxicity.train(d, t, remainder("doc_id", 5) != 0), toxicity.score_toxicity),
        (lambda d, t: langid.train(d, remainder("doc_id", 5) != 0), langid.identify),
    ):
        plain = scored(docs, build(docs, tables["labels"]))
        other = scored(docs, build(moved, flipped))
        a = {row.doc_id: row.score for row in plain.collect()}
        b = {row.doc_id: row.score for row in other.collect()}
        assert a.keys() == b.keys()
        assert max(abs(a[k] - b[k]) for k in a) < 1e-6


LEARN = [
    (k, ("good words make a sound text number%d " % k) * 8 if k % 2 else "bad ## ## ## line%d " % k * 20, "en" if k % 2 else "de")
    for k in range(100, 160)
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD_TEXTS + LEARN)


@pytest.fixture(scope="module")
def odd_labels(spark):
    known = [(k, k % 2, 1 - k % 2, "x") for k, *_ in LEARN]
    return labels(spark, [*known, *known[:5], (100, 1, 0, "other"), (None, 1, 1, "x"), (101, None, None, "x")])


def test_odd_rows_are_scored(odd, odd_labels):
    for got in (
        nbsvm.score_quality(odd, nbsvm.train(odd, odd_labels, F.lit(True))),
        toxicity.score_toxicity(odd, toxicity.train(odd, odd_labels, F.lit(True))),
        quality.judge(odd, quality.train(odd, odd_labels)),
        langid.identify(odd, langid.train(odd)),
    ):
        rows = got.collect()
        assert len(rows) == len(ODD_TEXTS) + len(LEARN)
        assert all(0 <= row.score <= 1 for row in rows)
        assert len({row.score for row in rows if row.doc_id in (2, 3)}) == 1  # null is empty
        assert len({row[1:] for row in rows if row.doc_id == 7}) == 1  # repeated rows agree


def test_without_labels_or_documents(spark, odd, odd_labels):
    none = documents(spark, [])
    no_labels = labels(spark, [])
    for docs, known in ((odd, no_labels), (none, odd_labels), (none, no_labels)):
        count = docs.count()
        model = nbsvm.train(docs, known, F.lit(True))
        assert {row.score for row in nbsvm.score_quality(docs, model).collect()} <= {0.5}
        scored = toxicity.score_toxicity(docs, toxicity.train(docs, known, F.lit(True)))
        assert scored.count() == count
        assert quality.train(docs, known) is None
        judged = quality.judge(docs, None).collect()
        assert len(judged) == count and all(row.kept != row.base_failed for row in judged)
    untold = langid.identify(odd, langid.train(odd.withColumn("lang", F.lit(None).cast("string"))))
    assert {row.lang_pred for row in untold.collect()} == {"und"}
    assert langid.identify(none, langid.train(none)).count() == 0


def test_one_class_gives_its_share(odd, odd_labels):
    only = odd_labels.where("quality = 1")
    model = nbsvm.train(odd, only, F.lit(True))
    assert all(row.predicted == 1 for row in nbsvm.score_quality(odd, model).collect())


def test_no_letter_is_und_and_rejected(odd):
    rows = langid.identify(odd, langid.train(odd)).collect()
    for row in rows:
        if row.doc_id in (2, 3, 4, 7):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        else:
            assert row.lang_pred in ("en", "de")


def test_long_texts_lose_no_gram(monkeypatch):
    text = "abc déf 日本 ghi " * 500
    whole = langid.bag(text)
    assert whole.sum() == sum(
        sum(map(str.isalpha, text)) if n == 1
        else sum(any(map(str.isalpha, g)) if n == 2 else g[1].isalpha() for g in zip(*[f" {text} "[k:] for k in range(n)], strict=False))
        for n in (1, 2, 3)
    )
    monkeypatch.setattr(langid, "PIECE", 100)
    assert (langid.bag(text) == whole).all()


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {k + i for k, w in enumerate(windows) if counts[w] > 1 for i in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (
        len(words), sum(map(len, words)), symbols,
        sum(line in lines[:k] for k, line in enumerate(lines)), len(repeated),
    )


def test_statistics_equal_brute_force(spark, tables):
    texts = [row.text for row in tables["documents"].limit(150).collect()]
    texts += [text for _, text in ODD_TEXTS if text != LONG]
    texts += ["a b c a b c", "a b a b a b a", "x\n\n x\nx\n", "a a a", "a a a a", "\x85a b\x1fc", "a\x0bb\nc"]
    for text in texts:
        assert quality.statistics(text)[0] == by_hand(text)


def test_rules_query(spark, tables):
    rows = QUERIES["op2_quality_rules"](spark, SF).collect()
    texts = {row.doc_id: row.text for row in tables["documents"].collect()}
    good = {row.doc_id: row.quality for row in tables["labels"].collect()}
    right = []
    for row in rows:
        assert tuple(row[name] for name in quality.BASE) == by_hand(texts[row.doc_id])
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.kept and row.base_failed)
        if not row.base_failed and row.doc_id in good:
            right.append(row.kept == good[row.doc_id])
    assert np.mean(right) > 0.97


def test_trees_obey_their_constraints_and_learn():
    draw = np.random.default_rng(0)
    x = draw.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.3 * draw.normal(size=3000)) > 0.6).astype(float)
    trees = quality.Booster([1, 0, -1], trees=40).fit(x, y, np.ones(3000))
    assert ((trees.margin(x) > 0) == y).mean() > 0.8
    for feature, way in ((0, 1), (2, -1)):
        grid = np.repeat(draw.random((40, 1, 3)), 50, axis=1)
        grid[:, :, feature] = np.linspace(-1, 2, 50)
        margins = trees.margin(grid.reshape(-1, 3)).reshape(40, 50)
        assert (way * np.diff(margins, axis=1) >= -1e-12).all()


def walk(trees, row):
    total = trees.start
    for root in trees.roots:
        node = root
        while trees.left[node] != node:
            side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
            node = side[node]
        total += trees.value[node]
    return total


def test_flat_trees_equal_a_walk():
    draw = np.random.default_rng(2)
    x = draw.random((400, 4))
    trees = quality.Booster([0] * 4, trees=10).fit(x, (x[:, 0] > x[:, 1]).astype(float), np.ones(400))
    assert np.allclose(trees.margin(x), [walk(trees, row) for row in x])


def test_label_model_finds_accuracies_and_correlations():
    """Voters drawn from a known model, two of them mostly copies of a third, some labels."""
    draw = np.random.default_rng(4)
    truth = draw.random(4000) < 0.3
    right = [0.9, 0.9, 0.9, 0.75, 0.8, 0.85]
    votes = np.array([np.where(draw.random(4000) < p, truth, ~truth) * 2 - 1 for p in right]).T
    for copy in (1, 2):
        same = draw.random(4000) < 0.9
        votes[same, copy] = votes[same, 0]
    label = np.where(np.arange(4000) < 1500, truth, -1)
    model, posterior = toxicity.fit_label_model(votes, label, np.ones(4000))
    assert ((posterior > 0.5) == truth)[1500:].mean() > 0.93
    correlations = model.correlations()
    assert correlations[0, 1] > 0.5 and abs(correlations[3, 4]) < 0.2
    assert np.abs(model.accuracies().mean(axis=1) - right).max() < 0.05


def test_dual_coordinate_descent_separates():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, 50, 8)).astype(np.int32) for _ in range(300)]
    label = np.array([int(1 in row) for row in rows])
    values = [np.ones(len(row), np.float32) for row in rows]
    w, bias = nbsvm.dual_coordinate_descent(rows, values, label, np.full(300, 10.0), epochs=60)
    margins = np.array([w[row].sum() + bias for row in rows])
    assert ((margins > 0) == label).all()


def test_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    few = learning.sample_of(rows.repartition(3), 1000, "doc_id")
    many = learning.sample_of(rows.repartition(50), 1000, "doc_id")
    assert rows_of(few, "doc_id") == rows_of(many, "doc_id")
    assert 850 < few.count() < 1150
