"""SentencePiece encoding and decoding.

The pieces of a model file form an Aho-Corasick automaton. A text drives it in one pass; at
each position its output links name every piece that ends there, longest first, and each
relaxes the best score of its end. The best path by summed scores is followed back. A
character that no piece covers costs a fixed penalty and becomes its UTF-8 bytes' pieces.
Of equal scores the path with the longer last piece wins.

No piece of the model has a word mark after another character, so a path never crosses the
start of a word, nor does it cross from a word to punctuation that no piece joins to it. So
texts are encoded part by part, which gives the same path as in one, and a part met again is
looked up.

Defined cases: a null text counts as empty and has no id; repeated rows are encoded one by
one; a text that holds the word mark itself (U+2581) reads back with a space there, any other
text reads back exactly; very long words are one pass as well.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import merge
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from tallyline.llm.common import Recent, pick, ship

MARK = "▁"
#: What an uncovered character costs beyond the lowest score of a piece.
UNKNOWN_PENALTY = 10.0
KNOWN_PARTS = 300_000
KNOWN_LENGTH = 64


def _part_pattern(apart: str) -> str:
    """Parts of a marked text: a word with the marks before it, cut where ``apart`` begins or
    ends."""
    if not apart:
        return f"{MARK}*[^{MARK}]+|{MARK}+"
    inside = re.escape(apart)
    return f"{MARK}*(?:[^{MARK}{inside}]+|[{inside}]+)|{MARK}+"


class Lattice:
    """An Aho-Corasick automaton over pieces and the best path through what it finds."""

    def __init__(self, pieces: dict[str, tuple[int, float]], unknown: float):
        self.automaton = ahocorasick.Automaton()
        for piece, (id_, score) in pieces.items():
            self.automaton.add_word(piece, (len(piece), id_, score))
        self.automaton.make_automaton()
        self.covered = {piece for piece in pieces if len(piece) == 1}
        self.unknown = unknown

    def _ends(self, text: str) -> Iterator[tuple[int, tuple[int, int, float]]]:
        """The automaton's finds, position by position and longest first, and after those of
        an uncovered character the character itself at the penalty."""
        uncovered = [k for k, char in enumerate(text) if char not in self.covered]
        finds = self.automaton.iter(text)
        if not uncovered:
            return finds
        alone = ((k, (1, -1, self.unknown)) for k in uncovered)
        return merge(finds, alone, key=itemgetter(0))

    def best_path(self, text: str) -> tuple[list[tuple[int, int]], float]:
        """(length, id) along the best path, id -1 for an uncovered character; its score."""
        best = [float("-inf")] * len(text) + [0.0]  # by last character; the start is at -1
        came = [None] * len(text)
        for last, find in self._ends(text):
            length, _, score = find
            score += best[last - length]
            if score > best[last]:
                best[last] = score
                came[last] = find
        path, last = [], len(text) - 1
        while last >= 0:
            length, id_, _ = came[last]
            path.append((length, id_))
            last -= length
        path.reverse()
        return path, best[len(text) - 1]


class Codec:
    """Encodes and decodes with the pieces and scores of a model file."""

    def __init__(self, model: SentencePieceProcessor):
        if model.normalize("a  b") != f"{MARK}a{MARK}{MARK}b":
            raise ValueError("only models that mark spaces and keep all else are supported")
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        pieces = {}
        for id_ in range(model.get_piece_size()):
            piece = model.id_to_piece(id_)
            if model.is_byte(id_):
                self.byte_ids[int(piece[1:-1], 16)] = id_
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(id_) or model.is_unknown(id_) or model.is_unused(id_):
                self.bytes_of.append(b"")
            else:
                pieces[piece] = (id_, model.get_score(id_))
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        if len(self.byte_ids) != 256:
            raise ValueError("only models with a piece for every byte are supported")
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        lowest = min(score for _, score in pieces.values())
        self.lattice = Lattice(pieces, lowest - UNKNOWN_PENALTY)
        self.known = _Parts(self)
        self.part = re.compile(_part_pattern(_apart([*pieces])))

    def _encode(self, text: str) -> tuple[bytes, float]:
        path, score = self.lattice.best_path(text)
        ids, start = [], 0
        for length, id_ in path:
            if id_ >= 0:
                ids.append(id_)
            else:
                raw = text[start].encode("utf-8", "surrogatepass")
                ids.extend(self.byte_ids[byte] for byte in raw)
            start += length
        return np.array(ids, np.int32).tobytes(), score

    def encode(self, text: str | None) -> tuple[np.ndarray, float]:
        """Ids and the summed score."""
        if not text:
            return np.empty(0, np.int32), 0.0
        marked = MARK + text.replace(" ", MARK)
        known = self.known
        found = [known[part] for part in (self.part.findall(marked) if self.by_word else [marked])]
        ids = np.frombuffer(b"".join([part[0] for part in found]), np.int32)
        return ids, sum([part[1] for part in found])

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        text = b"".join([self.bytes_of[id_] for id_ in np.asarray(ids, int).tolist()]).decode("utf-8", "replace")
        return text.removeprefix(" ")


def _crossings(pieces: Iterable[str], chars: set[str]) -> Iterator[tuple[str, str]]:
    """Neighbours in a piece of which one is in ``chars`` and the other neither that nor a
    word mark: (the one in ``chars``, the other)."""
    for piece in pieces:
        for a, b in zip(piece, piece[1:], strict=False):
            if MARK not in (a, b) and (a in chars) != (b in chars):
                yield (a, b) if a in chars else (b, a)


def _apart(pieces: Sequence[str]) -> str:
    """Punctuation, and what pieces join to it, that no piece joins to anything else: a path
    never crosses from one to the other. Empty if the pieces keep nothing apart."""
    chars = set(string.punctuation)
    chars -= {one for one, other in _crossings(pieces, chars) if other.isalpha()}
    chars |= {other for _, other in _crossings(pieces, chars)}
    return "".join(sorted(chars)) if not any(_crossings(pieces, chars)) else ""


class _Parts(Recent):
    """The encoded parts of texts met lately."""

    def __init__(self, codec: Codec):
        super().__init__(KNOWN_PARTS)
        self.codec = codec

    def __missing__(self, part: str) -> tuple[bytes, float]:
        found = super().__missing__(part)
        if found is None:
            found = self.codec._encode(part)
            if len(part) <= KNOWN_LENGTH:
                self.put(part, found)
        return found


@lru_cache(maxsize=2)
def codec(model_path: str) -> Codec:
    return Codec(SentencePieceProcessor(model_file=model_path))


ENCODED = "doc_id long, ids array<int>, n_ids long, score double, round_trip boolean"

#: Documents whose ids a worker holds at once.
ROWS = 500


def encode_documents(documents: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``ids``, ``n_ids``, ``score`` of the best path, and ``round_trip``, whether
    the ids decode to the text. Every worker machine reads the model at ``model_path``."""
    ship(documents.sparkSession)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec_ = codec(model_path)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                rows = batch.iloc[start : start + ROWS]
                found = [codec_.encode(text) for text in rows["text"]]
                yield pd.DataFrame(
                    {
                        "doc_id": rows["doc_id"].astype("Int64"),
                        "ids": [ids for ids, _ in found],
                        "n_ids": [len(ids) for ids, _ in found],
                        "score": [score for _, score in found],
                        "round_trip": [
                            codec_.decode(ids) == (text or "")
                            for (ids, _), text in zip(found, rows["text"], strict=True)
                        ],
                    }
                )

    return (
        pick(documents, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), "text")
        .mapInPandas(encoded, ENCODED)
    )


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; null ids give a null text."""
    ship(encoded.sparkSession)

    @F.pandas_udf(T.StringType())
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec_ = codec(model_path)
        for rows in batches:
            yield pd.Series([None if ids is None else codec_.decode(ids) for ids in rows])

    return pick(encoded, "doc_id", "ids").select("doc_id", decoded("ids").alias("text"))
