"""The pipeline stage by stage, and what the driver does to the repository."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from llm_frames import SF_DIR, rows_of
from test_minhash import by_hand

from tallyline.llm import packing

ROOT = Path(__file__).resolve().parents[2]


def test_stages_take_effect_and_keep_the_columns(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bad = {row.doc_id for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").collect()}
    docs, columns = documents, documents.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "language ID", "near-duplicates", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {row.doc_id: row.text for row in docs.collect()}
        docs = stage(spark, docs, SF_DIR)
        after = {row.doc_id: row.text for row in docs.collect()}
        assert docs.columns == columns
        assert after.items() <= before.items()
        if name == "quality classifier":
            assert bad & set(before) and not bad & set(after)
        elif name == "language ID":
            assert len(after) >= 0.99 * len(before)
        else:
            kept = {row[0] for row in by_hand([*before.items()], 5) if row[3]}
            assert set(after) == kept
    packed = corpus_pipeline.pack(spark, docs, SF_DIR)
    assert {row.doc_id for row in packed.select("doc_id").collect()} == set(after)


def test_run_equals_its_stages(spark):
    run = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_DIR)
    pieces = packing.pieces_of(docs, public_tokenizers.path("byte_bpe_50k.json"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(run, *columns) == rows_of(pieces, *columns)


def test_the_rest_stands_without_the_subpackage():
    """The entry module imports where the subpackage cannot be found, and only then."""
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {absent!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), sum(name.startswith("op") for name in entry.queries()), "pipeline" in entry.queries())
"""

    def run(*absent):
        return subprocess.run(
            [sys.executable, "-B", "-c", code.format(absent=absent)], cwd=ROOT, capture_output=True, text=True
        )

    rest, ops, pipeline = run("tallyline.llm", "corpus_pipeline").stdout.split()
    assert (ops, pipeline) == ("0", "False") and int(rest) > 60
    assert run().stdout.split()[1:] == ["10", "True"]
    assert run("tallyline.llm.chat").returncode
