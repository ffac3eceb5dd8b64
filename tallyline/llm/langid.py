"""Language identification by averaged hashed subword embeddings.

A text is the bag of the 1- to 3-grams of its letters, lower-cased, word edges included; each
is hashed to an embedding, the embeddings are averaged and a linear softmax names the
language. Embeddings and softmax are learned together by stochastic gradient descent in
numpy. On rows kept from the fit a temperature makes the probabilities honest, and a
threshold is set below which a prediction is rejected.

Scoring reads whole texts: embedding and softmax are one product, a table of a row for each
hash, so a text costs a gather and a sum.

Defined cases: a null text or one without a letter is ``und`` with score 0, and rejected;
very long texts are read in pieces of bounded size whose sums add up; repeated rows are
judged one by one; without any labelled row all texts are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import pick, ship
from tallyline.llm.learning import copy_weights, share_of, sketch

BITS = 14
WIDTH = 16
#: Most labelled rows that are fitted on, for each language.
SAMPLE_ROWS = 800
#: The threshold is this part of the certainty that all right predictions but a share reach:
#: short and mixed texts in a known language are uncertain too, and are to be kept.
REJECT_SHARE = 0.001
REJECT_MARGIN = 0.5
UNKNOWN = "und"
PIECE = 1 << 20

JUDGED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _piece_buckets(points: np.ndarray, begin: int) -> np.ndarray:
    """Hashes of the grams that begin among the first ``begin`` points."""
    c = np.where(_letters()[points], points, 0).astype(np.uint64)
    found = []
    mixed = c * np.uint64(0x9E3779B97F4A7C15)
    letter = c > 0
    for n in (1, 2, 3):
        if len(c) < n:
            break
        h = mixed[: len(c) - n + 1].copy()
        for k in range(1, n):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : len(c) - n + 1 + k]
        if n == 1:
            valid = letter
        elif n == 2:
            valid = letter[:-1] | letter[1:]
        else:
            valid = letter[1:-1]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + np.uint64(n)
        found.append((h[:begin][valid[:begin]] >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.empty(0, np.int32)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Hashes of the text's grams, with repeats. A piece reaches into the next by a gram."""
    padded = f" {text.lower()} "
    for start in range(0, len(padded), PIECE):
        piece = padded[start : start + PIECE + 2]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        yield _piece_buckets(points, PIECE)


def bag(text: str) -> np.ndarray:
    """Counts of the text's hashes, as a vector."""
    total = np.zeros(1 << BITS, np.int64)
    for piece in buckets(text):
        total += np.bincount(piece, minlength=1 << BITS)
    return total


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # a row of class scores for each hash
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        total, count = np.zeros(len(self.langs)), 0
        for piece in buckets(text):
            counts = np.bincount(piece, minlength=1 << BITS)
            total += counts @ self.table
            count += len(piece)
        return total / max(count, 1) + self.bias

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        p = softmax(self.logits(text)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _averages(rows, which) -> np.ndarray:
    x = np.zeros((len(which), 1 << BITS), np.float32)
    for k, row in enumerate(which):
        at, counts = rows[row]
        x[k, at] = counts / max(counts.sum(), 1)
    return x


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], label: np.ndarray, weight: np.ndarray,
    held: np.ndarray, epochs: int = 30, batch: int = 32, rate: float = 1.0, seed: int = 3,
    reject_share: float = REJECT_SHARE,
) -> Model:
    """Stochastic gradient descent over (hashes, counts) rows, then the calibration."""
    if not len(rows):
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    random = np.random.default_rng(seed)
    embed = random.normal(0, 0.3, (1 << BITS, WIDTH)).astype(np.float32)
    out = random.normal(0, 0.3, (WIDTH, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    learn = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    squares = [np.full_like(a, 1e-6) for a in (embed, out, bias)]  # steps scaled as in AdaGrad
    for _ in range(epochs):
        order = random.permutation(learn)
        for start in range(0, len(order), batch):
            which = order[start : start + batch]
            x = _averages(rows, which)
            used = np.flatnonzero(x.any(axis=0))
            x = x[:, used]
            hidden = x @ embed[used]
            p = softmax(hidden @ out + bias)
            p[np.arange(len(which)), label[which]] -= 1
            error = (p * weight[which, None] / max(weight[which].sum(), 1e-9)).astype(np.float32)
            for array, square, at, gradient in (
                (embed, squares[0], used, x.T @ (error @ out.T)),
                (out, squares[1], slice(None), hidden.T @ error),
                (bias, squares[2], slice(None), error.sum(axis=0)),
            ):
                square[at] += gradient**2
                array[at] -= 0.1 * rate * gradient / np.sqrt(square[at])
    model = Model(langs, (embed @ out).astype(np.float64), bias.astype(np.float64))
    _calibrate(model, rows, label, np.flatnonzero(held) if held.any() else learn, reject_share)
    return model


def _calibrate(model: Model, rows, label: np.ndarray, judged: np.ndarray, reject_share: float) -> None:
    logits = np.array([rows[k][1] / max(rows[k][1].sum(), 1) @ model.table[rows[k][0]] for k in judged])
    logits += model.bias
    truth = label[judged]

    def loss(temperature: float) -> float:
        p = softmax(logits / temperature)
        return -float(np.log(np.maximum(p[np.arange(len(p)), truth], 1e-12)).mean())

    model.temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    p = softmax(logits / model.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    if len(right):
        model.threshold = float(right[int(reject_share * len(right))]) * REJECT_MARGIN
    model.threshold = max(model.threshold, 1.0 / len(model.langs))


def _bags_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bags = [bag(text) for text in batch["text"]]
        at = [np.flatnonzero(b).astype(np.int32) for b in bags]
        yield pd.DataFrame(
            {
                "lang": batch["lang"],
                "at": [a.tobytes() for a in at],
                "counts": [b[a].astype(np.int32).tobytes() for a, b in zip(at, bags, strict=True)],
                "sketch": [sketch(text) for text in batch["text"]],
            }
        )


def train(documents: DataFrame, allowed: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``text`` and ``lang`` of the documents that ``allowed`` (a condition on
    ``doc_id``) lets it learn from: about ``sample_rows`` of each language at most."""
    ship(documents.sparkSession)
    allowed = F.lit(True) if allowed is None else allowed
    known = pick(documents, "doc_id", "text", "lang").where(
        allowed & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    langs = sorted(counts)
    parts = F.create_map(
        *[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_rows / counts[lang]))]
    ) if langs else F.create_map(F.lit(""), F.lit(0.0))
    rows = (
        known.where(share_of("doc_id", "text") < parts[F.col("lang")])
        .select("lang", "text")
        .distinct()  # rows that repeat were chosen together
        .mapInPandas(_bags_of, "lang string, at binary, counts binary, sketch long")
        .toPandas()
        .sort_values(["sketch", "lang", "at", "counts"], ignore_index=True)  # tasks end in any order
    )
    bags = [
        (np.frombuffer(a, np.int32), np.frombuffer(c, np.int32))
        for a, c in zip(rows["at"], rows["counts"], strict=True)
    ]
    sketches = rows["sketch"].to_numpy(np.int64)
    label = rows["lang"].map(langs.index).to_numpy(int)
    return fit(bags, langs, label, copy_weights(sketches), sketches % 5 == 0)


def judge_column(spark, model: Model):
    """A column function from texts to (``lang_pred``, ``score``, ``rejected``)."""
    shared = ship(spark).sparkContext.broadcast(model)

    @F.pandas_udf(JUDGED)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model_ = shared.value
        for texts in batches:
            yield pd.DataFrame([model_.judge(text) for text in texts], columns=JUDGED.names)

    return judged


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``rejected`` of every document."""
    judged = judge_column(documents.sparkSession, model)
    return (
        pick(documents, "doc_id", "text")
        .select("doc_id", judged("text").alias("judged"))
        .select("doc_id", "judged.*")
    )
