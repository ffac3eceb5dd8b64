"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its ids and an end id; a longer one than a sequence is cut, the first piece
taking what is left over. Pieces are then packed bulk-synchronously: pieces and gaps are kept
in order of length, all pieces of a length move in one round, longest first, and the sweep
hands each the smallest gap that holds it. Pieces of one length differ by rank alone, so does
a conflict: the k-th piece of a length gets the k-th place. Gaps are updated, and the next
length follows.

Equal pieces and equal gaps are kept as runs. A round is thus a few steps over runs (there
are no more lengths than tokens in a sequence), whatever the number of documents, and gives
what moving them one by one would. What grows with the data stays on Spark: tokenising,
ranking the pieces of each length, and giving every piece the place that its rank has.
Ranks need no task that sees a whole length: a piece is ranked in its block, and the blocks'
counts are added up.

Defined cases: a null text counts as empty and is the end id alone; repeated rows, and rows
without an id, are packed one by one; an empty table gives an empty result; whole texts are
tokenised.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm.common import kept, pick, ship

CAPACITY = 2048
END_ID = 0

#: Fixed value: the pattern by which byte-level pair encodings cut a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Texts of other characters go through the file's own library: whether those are letters,
#: digits or spaces may depend on the release of Unicode that a library follows.
_OTHER = r"[^\t\n\r\x20-\x7e\xa1-\u024f\u2018-\u201e]"


class Ids:
    """Ids of texts as little-endian 32-bit bytes, as the file's own library gives them.

    The file's vocabulary and cutting pattern also drive a faster encoder, which gives the same
    ids for texts in Latin script without strings that have an id of their own.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        characters = dict(zip(bytes_char().values(), bytes_char().keys(), strict=True))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {
            bytes(characters[c] for c in token): id_
            for token, id_ in vocabulary.items()
            if all(c in characters for c in token)
        }
        added = self.tokenizer.get_added_tokens_decoder()
        strings = [token.content for token in added.values()]
        for string in strings:
            ranks.pop(string.encode(), None)
        self.needs_library = re.compile("|".join([_OTHER, *map(re.escape, strings)])).search
        self.fast = tiktoken.Encoding(
            Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.needs_library(text):
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            return np.array(encoded.ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def bytes_char() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it
    can be seen, else the next one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def ids_of(tokenizer_path: str) -> Ids:
    return Ids(tokenizer_path)


def cut(n_ids: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    start, length = 0, n_ids % capacity or min(n_ids, capacity)
    while start < n_ids:
        yield start, length
        start, length = start + length, capacity


def plan(counts: Mapping[int, int], capacity: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Places for ``counts`` pieces of each length, best fit, longest first.

    Yields (length, first rank, pieces, first sequence, pieces a sequence, offset): the ranks
    of a run fill the run's sequences one after another from the offset on.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap size: (first sequence, sequences)
    sizes: list[int] = []
    opened = 0

    def put(size: int, first: int, number: int) -> None:
        if size and number:
            if size not in runs:
                runs[size] = []
                insort(sizes, size)
            runs[size].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)  # the successor: the smallest gap that holds it
            if at < len(sizes):
                gap = sizes[at]
                first, number = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], sizes[at]
            else:
                gap, each = capacity, capacity // length
                first, number = opened, -(-left // each)
                opened += number
            each = gap // length  # what is left of a best gap is again the best one
            full = min(number, left // each)
            if full:
                yield length, rank, full * each, first, each, capacity - gap
                put(gap - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < number:
                yield length, rank, left, first + full, left, capacity - gap
                put(gap - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(gap, first + full, number - full)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, place long"
PLACES = "length int, first_rank long, pieces long, first_sequence long, each long, base long"


def pieces_of(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``piece``, ``start``, ``length`` and the
    checksum of its ids. Every worker machine reads the tokenizer at ``tokenizer_path``."""
    ship(documents.sparkSession)

    def tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = ids_of(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text, place in zip(batch["doc_id"], batch["text"], batch["place"], strict=True):
                raw = ids(text) + end
                for piece, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc, place))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "place"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return (
        pick(documents, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("place"))
        .mapInPandas(tokenised, PIECES)
    )


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset`` of every piece."""
    spark = documents.sparkSession
    pieces = kept(pieces_of(documents, tokenizer_path, capacity), "pieces").withColumn(
        "block", F.shiftright("place", 33)  # the task that read the document
    )
    by_block = pieces.groupBy("block", "length").agg(F.count("*").alias("pieces"))
    counts = {row.length: row.pieces for row in by_block.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_block.select(
        "block", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before")
    )
    in_block = Window.partitionBy("block", "length").orderBy("place", "piece")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(in_block) - 1)
        .join(offsets, ["block", "length"])
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    # At most a few runs for each of the lengths up to the capacity, whatever the documents.
    places = spark.createDataFrame([*plan(counts, capacity)], PLACES)
    within = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(F.broadcast(places), "length")
        .where((within >= 0) & (within < F.col("pieces")))
        .select(
            "doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32",
            (F.col("first_sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
            (F.col("base") + within % F.col("each") * F.col("length")).alias("offset"),
        )
    )
