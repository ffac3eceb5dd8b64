"""A corpus pipeline: documents are filtered, deduplicated and packed.

Every stage takes the documents that the one before has kept, as a written table, and all but
the last return documents with the columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import langid, minhash, nbsvm, packing
from tallyline.llm.common import kept, table

#: SQL cannot express trained models, so the run is tested against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the corpus, does not reject."""
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    score = nbsvm.scorer(spark, model)
    return docs.where(score(F.col("text")) >= 0.5)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with enough confidence."""
    judged = langid.judge_column(spark, langid.train(docs))
    return docs.where(~judged(F.col("text"))["rejected"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.without_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = kept(docs, "documents")
    return docs
