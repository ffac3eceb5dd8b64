"""Quality rules: document statistics, a base rule, and gradient-boosted trees over them.

Every text gives a row of statistics. Trees are boosted on the logistic loss over histograms
of the statistics; a split that would break a monotonic constraint is not taken, and the
leaves below a constrained split are held on their sides of its middle. The trees are
flattened into arrays of nodes (feature, threshold, left child, value), through which all
rows of a batch walk at once.

Defined cases: a null or empty text has no word, so its counts are 0 and the base rule drops
it; whole texts are read; repeated rows are judged one by one; without labelled rows of both
classes the trees keep everything that the base rule keeps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import pick, ship
from tallyline.llm.learning import copy_weights, labelled_texts, sigmoid, sketch

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"

MIN_WORDS = 50
#: Most percent of words in repeated 3-word windows.
MAX_REPEATED_PERCENT = 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The statistics the trees see, and for each the way in which it may move the verdict:
#: -1 a larger value can only lower it, +1 only raise it, 0 free.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_a_word": -1, "dup_lines_a_line": -1,
    "repeated_words": -1, "upper_letters": -1, "digits": 0, "stops": 0, "exclamations": -1,
    "distinct_words": 0, "words_without_letter": -1, "words_a_line": 0, "top_word": -1,
    "words_again": -1,
}

#: Most labelled rows that are fitted on.
SAMPLE_ROWS = 8_000


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the features of a whole text.

    Words are runs without ASCII white space. A word is repeated if a window of three words
    that it is in occurs twice or more in the text.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text or "") - sum(map(raw.count, (bytes([c]) for c in SPACES)))
    symbols = sum(map(raw.count, (bytes([c]) for c in SYMBOLS)))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = _repeated(words)
    if not n:
        return (0, chars, symbols, dup_lines, 0), (0.0,) * len(FEATURES)
    counts = Counter(words)
    letters = sum(map(str.isalpha, text)) if not text.isascii() else _ascii_letters(raw)
    upper = sum(map(str.isupper, text)) if not text.isascii() else _ascii_upper(raw)
    no_letter = sum(k for word, k in counts.items() if not any(map(str.isalpha, word.decode("utf-8", "surrogatepass"))))
    features = (
        math.log1p(n), chars / n, symbols / n, dup_lines / max(len(lines), 1),
        repeated / n, upper / max(letters, 1), sum(map(raw.count, _DIGITS)) / max(chars, 1),
        (raw.count(b".") + raw.count(b",")) / n, raw.count(b"!") / n,
        len(counts) / n, no_letter / n, n / max(len(lines), 1),
        (max(counts.values()) - 1) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
    )
    return (n, chars, symbols, dup_lines, repeated), features


_DIGITS = [bytes([c]) for c in b"0123456789"]
_NOT_LETTERS = bytes(c for c in range(256) if not chr(c).isalpha() or c > 127)
_NOT_UPPER = bytes(c for c in range(256) if not (65 <= c <= 90))


def _ascii_letters(raw: bytes) -> int:
    return len(raw.translate(None, _NOT_LETTERS))


def _ascii_upper(raw: bytes) -> int:
    return len(raw.translate(None, _NOT_UPPER))


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0  # words before ``covered`` have been counted
    for start, window in enumerate(windows):
        if counts[window] > 1:
            total += start + 3 - max(start, covered)
            covered = start + 3
    return total


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


@dataclass
class Trees:
    """Nodes of all trees in flat arrays. A leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total


class Booster:
    """Histogram boosting on the logistic loss under monotonic constraints."""

    def __init__(self, monotonic, trees=60, depth=4, rate=0.15, bins=64, ridge=1.0, least=5.0):
        self.monotonic = np.asarray(monotonic)
        self.trees, self.depth, self.rate = trees, depth, rate
        self.bins, self.ridge, self.least = bins, ridge, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack(
            [np.searchsorted(cut, c, "left") for cut, c in zip(cuts, x.T, strict=True)]
        )
        share = np.clip((weight @ y) / weight.sum(), 1e-3, 1 - 1e-3)
        start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), start)
        self.nodes: list[list] = []
        roots = []
        for _ in range(self.trees):
            p = sigmoid(margin)
            gradient, curvature = weight * (p - y), weight * p * (1 - p)
            roots.append(len(self.nodes))
            step = np.zeros(len(y))
            self._grow(binned, cuts, gradient, curvature, np.arange(len(y)), 0, -np.inf, np.inf, step)
            margin += step
        columns = list(zip(*self.nodes, strict=True))
        return Trees(
            *(np.array(c, t) for c, t in zip(columns, (int, float, int, int, float), strict=True)),
            np.array(roots), self.depth, start,
        )

    def _value(self, g, h, low, high):
        return np.clip(-g / (h + self.ridge), low, high)

    def _grow(self, binned, cuts, g, h, rows, depth, low, high, step) -> int:
        here = len(self.nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value = float(self._value(total_g, total_h, low, high))
        self.nodes.append([0, np.inf, here, here, self.rate * value])
        best = None
        if depth < self.depth:
            best = self._split(binned, cuts, g, h, rows, total_g, total_h, low, high)
        if best is None:
            step[rows] = self.rate * value
            return here
        _, f, b, left_value, right_value = best
        goes_left = binned[rows, f] <= b
        middle = (left_value + right_value) / 2
        bounds = [(low, high), (low, high)]
        if self.monotonic[f] > 0:
            bounds = [(low, middle), (middle, high)]
        elif self.monotonic[f] < 0:
            bounds = [(middle, high), (low, middle)]
        children = [
            self._grow(binned, cuts, g, h, rows[side], depth + 1, *bound, step)
            for side, bound in zip((goes_left, ~goes_left), bounds, strict=True)
        ]
        self.nodes[here] = [f, float(cuts[f][b]), *children, 0.0]
        return here

    def _split(self, binned, cuts, g, h, rows, total_g, total_h, low, high):
        """The best allowed (gain, feature, bin, left value, right value), or None."""
        best, stay = None, total_g**2 / (total_h + self.ridge)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
            left, right = self._value(gl, hl, low, high), self._value(total_g - gl, total_h - hl, low, high)
            gain = gl**2 / (hl + self.ridge) + (total_g - gl) ** 2 / (total_h - hl + self.ridge) - stay
            allowed = (nl >= self.least) & (len(rows) - nl >= self.least)
            allowed &= self.monotonic[f] * (right - left) >= 0
            gain = np.where(allowed, gain, -np.inf)
            at = int(gain.argmax())
            if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
                best = float(gain[at]), f, at, float(left[at]), float(right[at])
        return best


def fit(x: np.ndarray, label: np.ndarray, sketches: np.ndarray) -> Trees | None:
    if len(np.unique(label)) < 2:
        return None
    return Booster([*FEATURES.values()]).fit(x, label.astype(float), copy_weights(sketches))


def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "label": batch["label"].astype("int32"),
                "x": [list(statistics(text)[1]) for text in batch["text"]],
                "sketch": [sketch(text) for text in batch["text"]],
            }
        )


def train(
    documents: DataFrame, labels: DataFrame, allowed: Column | None = None, label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Trees | None:
    """Trees from the labels that ``allowed`` (a condition on ``doc_id``) lets them learn; the
    driver gets the statistics of at most about ``sample_rows`` texts."""
    ship(documents.sparkSession)
    allowed = F.lit(True) if allowed is None else allowed
    rows = (
        labelled_texts(documents, labels, label, allowed, sample_rows)
        .select("text", "label")
        .mapInPandas(_rows_of, "label int, x array<double>, sketch long")
        .toPandas()
    )
    if not len(rows):
        return None
    order = np.lexsort([*np.array(rows["x"].tolist()).T, rows["sketch"]])  # tasks end in any order
    rows = rows.iloc[order]
    return fit(np.array(rows["x"].tolist()), rows["label"].to_numpy(), rows["sketch"].to_numpy())


JUDGED = T.StructType(
    [T.StructField(name, T.LongType()) for name in BASE]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType())]
)


def judge(documents: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, the trees' ``score`` and ``kept``."""
    shared = ship(documents.sparkSession).sparkContext.broadcast(trees)

    @F.pandas_udf(JUDGED)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees_ = shared.value
        for texts in batches:
            found = [statistics(text) for text in texts]
            out = pd.DataFrame([base for base, _ in found], columns=BASE, dtype="int64")
            out["base_failed"] = [base_failed(base[0], base[4]) for base, _ in found]
            x = np.array([features for _, features in found]).reshape(-1, len(FEATURES))
            out["score"] = 1.0 if trees_ is None else sigmoid(trees_.margin(x))
            yield out

    return (
        pick(documents, "doc_id", "text")
        .select("doc_id", judged("text").alias("judged"))
        .select("doc_id", "judged.*")
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= 0.5))
    )
