"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (fixed groups of insults, and groups of words
induced from the learnable labels) and pattern voters. A generative label model takes the
votes as drawn from one distribution for each class: its means are the voters' accuracies,
its covariance their correlations, so that voters who repeat each other are not counted
twice. It is fitted by expectation maximisation over labelled and unlabelled rows (a known
label holds its row's posterior, up to a small share of wrong labels). A linear classifier
is then trained on the posterior labels and scores whole texts.

Defined cases: a null or empty text has no vote and gets the score of the bias; whole texts
are read; repeated rows are scored one by one; without any learnable label the label model
starts from the fixed lexicons alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import pick, ship
from tallyline.llm.learning import copy_weights, labelled_texts, sample_of, sigmoid, sketch

#: Groups of insults in several languages, without words that are harmless in
#: another of them (such as ``die`` or ``gross``).
LEXICONS = {
    "mind": "idiot idiots moron morons imbecile stupid dumb fool cretin dunce halfwit brainless",
    "worth": "trash garbage worthless pathetic useless scum filth vermin loser losers clown pig",
    "disgust": "disgusting repulsive nasty sickening ugly",
    "threat": "hate kill destroy",
    "french": "imbécile connard crétin salaud débile abruti ordure",
    "german": "dummkopf arschloch trottel abschaum schwachkopf wertlos",
    "spanish": "estúpido imbécil pendejo basura escoria inútil",
}

#: Most labelled rows, and most unlabelled ones, that are fitted on.
SAMPLE_ROWS = 5_000
UNLABELLED_ROWS = 1_000
INDUCED_GROUPS = 8
INDUCED_WORDS = 400
#: Words that the classifier weighs beside the votes.
CLASSIFIER_WORDS = 2_000
#: Rounds of expectation maximisation with known labels, and what a row without one counts.
LABELLED_ROUNDS = 10
UNLABELLED_WEIGHT = 0.1
#: Share of labels taken to be wrong.
LABEL_NOISE = 0.01

_WORD = re.compile(r"[^\W\d_]+")


#: Words that address the reader.
YOU = {"you", "your", "tu", "vous", "du", "ihr", "tú", "usted"}


@dataclass
class Words:
    """What voters and classifier see of a text: how often each word occurs, and the words
    that follow an address."""

    counts: dict[str, int]
    addressed: set[str]

    @classmethod
    def of(cls, text: str | None) -> Words:
        words = _WORD.findall((text or "").lower())
        counts = Counter(words)
        addressed = set()
        if not YOU.isdisjoint(counts):
            addressed = {b for a, b in zip(words, words[1:], strict=False) if a in YOU}
        return cls(counts, addressed)


@dataclass
class Voters:
    """Words to the lexicon voter they belong to, and the patterns."""

    lexicon: dict[str, int]
    names: list[str]
    fixed: int = len(LEXICONS)

    @classmethod
    def of(cls, induced: Sequence[str] = ()) -> Voters:
        names = [*LEXICONS]
        lexicon = {word: k for k, name in enumerate(names) for word in LEXICONS[name].split()}
        for rank, word in enumerate(induced):
            lexicon.setdefault(word, len(names) + rank % INDUCED_GROUPS)
        names += [f"induced{k}" for k in range(INDUCED_GROUPS)]
        return cls(lexicon, [*names, "none_fixed", "none_induced", "several", "dense", "near_you"])

    def votes(self, text: Words) -> np.ndarray:
        """+1 toxic, -1 clean, 0 abstains, for each voter."""
        groups = self.fixed + INDUCED_GROUPS
        out = np.zeros(len(self.names), np.int8)
        if not text.counts:
            return out
        hits = [word for word in text.counts if word in self.lexicon]
        out[[self.lexicon[word] for word in hits]] = 1
        none_fixed, none_induced, several, dense, near_you = range(groups, groups + 5)
        out[none_fixed] = 0 if out[: self.fixed].any() else -1
        out[none_induced] = 0 if out[self.fixed : groups].any() else -1
        total = sum(text.counts[word] for word in hits)
        out[several] = total > 1
        out[dense] = 50 * total > sum(text.counts.values())
        out[near_you] = not text.addressed.isdisjoint(hits)
        return out


@dataclass
class LabelModel:
    """Class shares, mean votes of each class and the covariance within classes."""

    share: float
    means: np.ndarray
    covariance: np.ndarray
    _weights: np.ndarray = field(init=False)
    _offset: float = field(init=False)

    def __post_init__(self):
        inverse = np.linalg.inv(self.covariance)
        self._weights = inverse @ (self.means[1] - self.means[0])
        self._offset = float(
            np.log(self.share / (1 - self.share))
            - (self.means[1] @ inverse @ self.means[1] - self.means[0] @ inverse @ self.means[0]) / 2
        )

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return sigmoid(votes @ self._weights + self._offset)

    def accuracies(self) -> np.ndarray:
        """Chance that a voter who speaks is right, for a toxic and for a clean text."""
        return np.column_stack([(1 + self.means[1]) / 2, (1 - self.means[0]) / 2])

    def correlations(self) -> np.ndarray:
        """Of the voters' votes within a class."""
        spread = np.sqrt(np.diag(self.covariance))
        return self.covariance / np.outer(spread, spread)


def fit_label_model(
    votes: np.ndarray, label: np.ndarray, weight: np.ndarray
) -> tuple[LabelModel, np.ndarray]:
    """The model and the posterior of each row. ``label`` is -1 where it is unknown.

    Rows without a label count for less than those with one, and where no label is known one
    round must do: voters who repeat each other would otherwise pull the classes to where
    they agree, round by round.
    """
    votes = votes.astype(float)
    known = label >= 0
    rounds = LABELLED_ROUNDS if known.any() else 1
    weight = np.where(known, weight, UNLABELLED_WEIGHT * weight) if known.any() else weight
    posterior = sigmoid(2.0 * votes.sum(axis=1))  # the start: an unweighed vote
    held = np.where(label == 1, 1 - LABEL_NOISE, LABEL_NOISE)
    model = None
    for _ in range(rounds):
        posterior = np.where(known, held, posterior)
        parts = [weight * (1 - posterior), weight * posterior]
        means = np.array([(p @ votes + 0.0) / (p.sum() + 1.0) for p in parts])
        covariance = 0.05 * np.eye(votes.shape[1])
        for p, mean in zip(parts, means, strict=True):
            apart = votes - mean
            covariance += (apart * p[:, None]).T @ apart / max(weight.sum(), 1.0)
        share = float(np.clip(parts[1].sum() / max(weight.sum(), 1e-9), 0.01, 0.99))
        model = LabelModel(share, means, covariance)
        posterior = model.posterior(votes)
    if known.any():  # a known label and the votes together
        odds = np.log(posterior / (1 - posterior) + 1e-12) + np.log(held / (1 - held))
        posterior = np.where(known, sigmoid(odds), posterior)
    return model, posterior


def induced_words(
    bags: list[dict[str, int]], label: np.ndarray, weight: np.ndarray, limit: int = INDUCED_WORDS
) -> list[str]:
    """Words that learnable labels call toxic: by the lower bound of their log odds, those
    that are at least four times likelier in toxic texts."""
    toxic, clean = Counter(), Counter()
    for bag, y, w in zip(bags, label, weight, strict=True):
        if y >= 0:
            counter = toxic if y else clean
            for word in bag:
                counter[word] += w
    n1 = float(weight[label == 1].sum()) + 1
    n0 = float(weight[label == 0].sum()) + 1
    ranked = []
    for word, t in toxic.items():
        if t >= 3:
            c = clean.get(word, 0.0)
            odds = np.log((t + 0.5) / n1) - np.log((c + 0.5) / n0)
            bound = odds - 1.96 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
            if bound > np.log(4):
                ranked.append((-bound, word))
    return [word for _, word in sorted(ranked)[:limit]]


@dataclass
class Model:
    voters: Voters
    words: dict[str, int]
    vote_weights: np.ndarray
    word_weights: np.ndarray
    bias: float
    label_model: LabelModel | None = None

    def score(self, text: str | None) -> float:
        seen = Words.of(text)
        margin = self.bias + float(self.voters.votes(seen) @ self.vote_weights)
        at = [self.words[word] for word in seen.counts if word in self.words]
        return float(sigmoid(margin + float(self.word_weights[at].sum())))


def fit_classifier(
    votes: np.ndarray, bags: list[list[int]], n_words: int, posterior: np.ndarray, weight: np.ndarray,
    steps: int = 400, penalty: float = 1e-3,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on soft labels by full gradients with momentum."""
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    col = np.concatenate([np.asarray(b, int) for b in bags]) if len(row) else np.zeros(0, int)
    a, v, b = np.zeros(votes.shape[1]), np.zeros(n_words), 0.0
    share = np.clip((weight @ posterior) / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)
    b = float(np.log(share / (1 - share)))
    moves = [np.zeros_like(a), np.zeros_like(v), 0.0]
    w = weight / max(weight.sum(), 1e-9)
    votes = votes.astype(float)
    for _ in range(steps):
        margin = votes @ a + b + np.bincount(row, v[col], len(bags))
        error = w * (sigmoid(margin) - posterior)
        gradients = (
            votes.T @ error + penalty * a,
            np.bincount(col, error[row], n_words) + penalty * v,
            float(error.sum()),
        )
        moves = [0.9 * m - 0.5 * g for m, g in zip(moves, gradients, strict=True)]
        a, v, b = a + moves[0], v + moves[1], b + moves[2]
    return a, v, b


def fit(texts: list[Words], label: np.ndarray, sketches: np.ndarray) -> Model:
    """A model from texts' words and labels (-1 where unknown)."""
    bags = [text.counts for text in texts]
    weight = copy_weights(sketches)
    induced = induced_words(bags, label, weight)
    voters = Voters.of(induced)
    if not len(texts):
        empty = np.zeros(len(voters.names))
        empty[: len(LEXICONS) + INDUCED_GROUPS] = 4.0
        return Model(voters, {}, empty, np.zeros(0), -2.0)
    votes = np.array([voters.votes(text) for text in texts])
    label_model, posterior = fit_label_model(votes, label, weight)
    seen = Counter()
    for bag in bags:
        seen.update(bag)
    listed = [word for word in induced if seen[word] >= 3]
    common = [word for word, n in seen.most_common(CLASSIFIER_WORDS) if n >= 20]
    chosen = {word: k for k, word in enumerate(dict.fromkeys([*listed, *common]))}
    at = [[chosen[word] for word in bag if word in chosen] for bag in bags]
    a, v, b = fit_classifier(votes, at, len(chosen), posterior, weight)
    return Model(voters, chosen, a, v, b, label_model)


def _words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [Words.of(text) for text in batch["text"]]
        yield pd.DataFrame(
            {
                "label": batch["label"].astype("int32"),
                "words": [" ".join(text.counts) for text in texts],
                "counts": [np.array([*text.counts.values()], np.int32).tobytes() for text in texts],
                "addressed": [" ".join(sorted(text.addressed)) for text in texts],
                "sketch": [sketch(text) for text in batch["text"]],
            }
        )


def train(
    documents: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """A model from the labels that ``allowed`` (a condition on ``doc_id``) lets it learn, and
    from unlabelled texts. The driver gets the distinct words of at most about
    ``sample_rows`` + ``unlabelled_rows`` texts."""
    ship(documents.sparkSession)
    labelled = labelled_texts(documents, labels, label, allowed, sample_rows)
    ids = pick(labels, "doc_id").where("doc_id is not null").distinct()
    others = pick(documents, "doc_id", "text").join(ids, "doc_id", "left_anti")
    unlabelled = (
        sample_of(others, unlabelled_rows, "doc_id", "text", seed=2)
        .select(F.coalesce("text", F.lit("")).alias("text"))
        .distinct()  # rows that repeat were chosen together
        .withColumn("label", F.lit(-1))
    )
    rows = (
        labelled.select("text", F.col("label").cast("int"))
        .unionByName(unlabelled)
        .mapInPandas(_words_of, "label int, words string, counts binary, addressed string, sketch long")
        .toPandas()
        .sort_values(["sketch", "words"], ignore_index=True)
    )
    texts = [
        Words(dict(zip(words.split(), np.frombuffer(counts, np.int32).tolist(), strict=True)), set(addressed.split()))
        for words, counts, addressed in zip(rows["words"], rows["counts"], rows["addressed"], strict=True)
    ]
    return fit(texts, rows["label"].to_numpy(int), rows["sketch"].to_numpy())


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` of every document."""
    shared = ship(documents.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model_ = shared.value
        for texts in batches:
            yield pd.Series([model_.score(text) for text in texts], dtype="float64")

    return (
        pick(documents, "doc_id", "text")
        .select("doc_id", score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
