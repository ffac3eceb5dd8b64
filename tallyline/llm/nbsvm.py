"""Quality classifier: naive Bayes support vectors.

The features of a text are indicators of n-grams: its words, and the shapes of its words
(letters by case, digits, other characters, runs collapsed) as 1-, 2- and 3-grams, where a
word that follows itself has a shape of its own. Indicators are scaled by the log-count ratios
of the two classes; a linear model is fitted on them under the hinge loss by dual coordinate
descent, and its margins are turned into probabilities on rows that the fit has not seen.

Defined cases: a null or empty text has no n-gram and gets the score of the bias; whole texts
are read whatever their length; repeated rows are scored one by one; with no labelled rows,
or one class only, every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import Recent, pick, ship
from tallyline.llm.learning import (
    copy_weights,
    fitted_sigmoid,
    labelled_texts,
    sigmoid,
    sketch,
)

BITS = 18
#: Most labelled rows that are fitted on; they are chosen by a hash of their id.
SAMPLE_ROWS = 8_000
KNOWN_WORDS = 100_000
KNOWN_LENGTH = 64

_CLASSES = (
    (re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() else "a"),
    (re.compile(r"\d+"), lambda m: "9"),
    (re.compile(r"([^\w\s])\1+"), lambda m: m[1]),
)
#: The shape of a word that follows itself.
_AGAIN = 1


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def shape(word: str) -> str:
    """``Hello,,`` is ``Aa,``: letters by case, digits, other characters, runs collapsed."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word.isupper():
            return "A"
        if word[1:].islower():
            return "Aa"
    for pattern, replacement in _CLASSES:
        word = pattern.sub(replacement, word)
    return word


class Grams:
    """Turns texts into sets of hashed n-grams; remembers the words it has met."""

    def __init__(self):
        self.words = Recent(KNOWN_WORDS)  # word: (hash of the word, hash of its shape)

    def _codes(self, word: str) -> tuple[int, int]:
        code = (_hash("w" + word.lower()), _hash("s" + shape(word)))
        if len(word) <= KNOWN_LENGTH:
            self.words.put(word, code)
        return code

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.empty(0, np.int32)
        known = self.words
        codes = [known[word] or self._codes(word) for word in words]
        found = {code[0] for code in codes}
        shapes = np.array([code[1] for code in codes], np.int64)
        again = np.fromiter(map(str.__eq__, words[1:], words), bool, len(words) - 1)
        shapes[1:][again] = _AGAIN
        grams = [np.array([*found], np.int64), np.unique(shapes)]
        mask = (1 << BITS) - 1
        for n in (2, 3):
            if len(shapes) >= n:
                mixed = np.full(len(shapes) - n + 1, n, np.int64)
                for k in range(n):
                    mixed = (mixed * 1_000_003 + shapes[k : len(shapes) - n + 1 + k]) & 0x7FFFFFFF
                grams.append(np.unique(mixed) * 2_654_435_761 >> 7 & mask)
        return np.unique(np.concatenate(grams)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum() / np.sqrt(max(len(grams), 1)) + self.bias)

    def score(self, grams: np.ndarray) -> float:
        return float(sigmoid(self.slope * self.margin(grams) + self.offset))


def log_count_ratios(rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How much more often each gram is in texts of label 1, smoothed by one text a class."""
    counts = np.ones((2, 1 << BITS))
    for k, grams in enumerate(rows):
        counts[label[k], grams] += weight[k]
    totals = np.bincount(label, weight, 2) + 2
    return (np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, cost: np.ndarray,
    epochs: int = 12, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum cost * max(0, 1 - y (w x + b)), by passes over
    the dual variables, each solved alone and clipped to [0, cost]."""
    w, bias = np.zeros(1 << BITS, np.float32), 0.0
    y = np.where(label == 1, 1.0, -1.0)
    alpha = np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            gap = 1.0 - y[k] * (float(w[rows[k]] @ values[k]) + bias)
            new = min(max(alpha[k] + gap / norms[k], 0.0), cost[k])
            if new != alpha[k]:
                change = (new - alpha[k]) * y[k]
                w[rows[k]] += change * values[k]
                bias += change
                alpha[k] = new
    return w, bias


def fit(rows: list[np.ndarray], label: np.ndarray, sketches: np.ndarray, cost: float = 1.0) -> Model:
    """A model from texts' grams and labels; each fifth row only serves the probabilities."""
    label = label.astype(int)
    weight = copy_weights(sketches)
    if len(np.unique(label)) < 2:
        share = float(label.mean()) if len(label) else 0.5
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(odds))
    held = sketches % 5 == 0
    if len(np.unique(label[held])) < 2 or len(np.unique(label[~held])) < 2:
        held = np.zeros(len(label), bool)
    learn = np.flatnonzero(~held)
    some = [rows[k] for k in learn]
    ratios = log_count_ratios(some, label[learn], weight[learn])
    scaled = [ratios[grams] / np.sqrt(max(len(grams), 1)) for grams in some]
    w, bias = dual_coordinate_descent(some, scaled, label[learn], cost * weight[learn])
    model = Model(w * ratios, bias, 1.0, 0.0)
    judged = np.flatnonzero(held) if held.any() else learn
    margins = np.array([model.margin(rows[k]) for k in judged])
    model.slope, model.offset = fitted_sigmoid(margins, label[judged], weight[judged])
    return model


def _grams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams = Grams()
    for batch in batches:
        found = [grams(text) for text in batch["text"]]
        yield pd.DataFrame(
            {
                "label": batch["label"].astype("int32"),
                "grams": [g.tobytes() for g in found],
                "sketch": [sketch(text) for text in batch["text"]],
            }
        )


def train(
    documents: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of the labels that ``allowed`` (a condition on ``doc_id``) lets it learn from.

    Grams are made in the tasks; the driver gets those of at most about ``sample_rows`` texts.
    """
    ship(documents.sparkSession)
    rows = (
        labelled_texts(documents, labels, label, allowed, sample_rows)
        .select("text", "label")
        .mapInPandas(_grams_of, "label int, grams binary, sketch long")
        .toPandas()
        .sort_values(["sketch", "label", "grams"], ignore_index=True)  # tasks end in any order
    )
    return fit(
        [np.frombuffer(g, np.int32) for g in rows["grams"]],
        rows["label"].to_numpy(), rows["sketch"].to_numpy(),
    )


def scorer(spark, model: Model):
    """A column function from texts to scores."""
    shared = ship(spark).sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = Grams()
        model_ = shared.value
        for texts in batches:
            yield pd.Series([model_.score(grams(text or "")) for text in texts], dtype="float64")

    return score


def score_quality(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` of every document."""
    score = scorer(documents.sparkSession, model)
    return (
        pick(documents, "doc_id", "text")
        .select("doc_id", score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
