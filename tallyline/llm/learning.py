"""Bounded samples of labelled rows, and what the linear models have in common."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import pick


def share_of(*keys: str, seed: int = 1) -> Column:
    """A number from 0 to 1 that depends on the keys alone."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(2**31)) / 2**31


def sample_of(rows: DataFrame, size: int, *keys: str, seed: int = 1) -> DataFrame:
    """About ``size`` of the rows, chosen by a hash of their keys alone: the same ones however
    the table is partitioned, all of them if there are no more. Rows with equal keys are
    chosen together, so where those may be many the caller must make the sample distinct."""
    total = rows.count()
    if total <= size:
        return rows
    return rows.where(share_of(*keys, seed=seed) < size / total)


def labelled_texts(
    documents: DataFrame, labels: DataFrame, label: str, allowed: Column, size: int
) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of about ``size`` labelled documents.

    ``allowed`` says by ``doc_id`` which labels may be learned. A document with two different
    labels has none; of documents with one id the smallest text stands for it. The sampled
    ids are broadcast, which ``size`` bounds.
    """
    known = (
        pick(labels, "doc_id", label)
        .where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    chosen = F.broadcast(sample_of(known, size, "doc_id"))
    return (
        pick(documents, "doc_id", "text")
        .join(chosen, "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("label").alias("label"))
    )


def sketch(text: str) -> int:
    """The smallest hash of the text's 3-word shingles: mostly equal for near copies."""
    words = text.split()
    shingles = set(zip(words, words[1:], words[2:], strict=False)) or {tuple(words)}
    return min(zlib.crc32(" ".join(s).encode("utf-8", "surrogatepass")) for s in shingles)


def copy_weights(sketches: np.ndarray) -> np.ndarray:
    """1 / the number of rows with the same sketch, so that copies count as one."""
    _, place, count = np.unique(sketches, return_inverse=True, return_counts=True)
    return 1.0 / count[place]


def sigmoid(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def fitted_sigmoid(
    margin: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 50
) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (Newton steps, slightly
    regularised so that separable margins give finite values)."""
    scale = max(float(np.abs(margin).max(initial=0)), 1e-9)
    x = np.column_stack([margin / scale, np.ones(len(margin))])
    beta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - label)) + 1e-2 * beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
    return max(float(beta[0]), 0.0) / scale, float(beta[1])
