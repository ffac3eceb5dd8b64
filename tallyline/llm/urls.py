"""URL filters over a sorted array of digests.

A list holds rules (host, path, verdict) and words of hosts. Every entry is a string; its
64-bit xxhash goes into a sorted array, its bytes into a blob beside it. A worker maps the
file into memory, probes all candidate strings of a batch by one vectorised binary search
and compares the stored bytes, so that equal digests of different strings never match.

A rule fits its host and all subdomains if the url's path starts with the rule's path; the
longest host + path wins, of equal ones the one with the longer host. Without a rule a host
that has a listed word between its dots and hyphens is blocked, any other url is allowed.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and is
allowed; repeated rows are judged one by one; an empty list allows all; of an entry that is
listed twice the last verdict holds.
"""

from __future__ import annotations

import re
import struct
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import pick, ship

ALLOW, BLOCK = "allow", "block"

#: Words of hosts that stand for spam, adult, gambling and tracking sites.
HOST_WORDS = (
    "ads", "adult", "bets", "betting", "casino", "escort", "gambling", "malware", "phishing",
    "poker", "porn", "sex", "spam", "torrent", "tracker", "viagra", "warez", "xxx",
)

#: Bytes of a list that are broadcast at once; a longer list is probed part by part.
PART_BYTES = 64 * 1024 * 1024

JUDGED = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("host_length", T.IntegerType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("listed_word", T.BooleanType()),
    ]
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def pack(entries: Iterable[tuple[str, str, int]]) -> bytes:
    """A list file of (string, verdict, host length): digests, offsets, host lengths,
    verdicts and strings, sorted by digest."""
    last = {text.encode(): (verdict, length) for text, verdict, length in entries}
    rows = sorted((xxhash.xxh64_intdigest(text), text) for text in last)
    texts = [text for _, text in rows]
    return b"".join(
        [
            struct.pack("<Q", len(rows)),
            np.array([digest for digest, _ in rows], "<u8").tobytes(),
            np.cumsum([0, *map(len, texts)]).astype("<u8").tobytes(),
            np.array([last[text][1] for text in texts], "<u4").tobytes(),
            np.array([last[text][0] == BLOCK for text in texts], "u1").tobytes(),
            *texts,
        ]
    )


class DigestList:
    """A list file mapped into memory."""

    def __init__(self, packed: bytes):
        with tempfile.TemporaryFile() as file:  # stays mapped after it is closed
            file.write(packed)
            file.flush()
            data = np.memmap(file, "u1", "r")
        count = int(data[:8].view("<u8")[0])
        ends = np.cumsum([8, 8 * count, 8 * (count + 1), 4 * count, count])
        self.digests = data[ends[0] : ends[1]].view("<u8")
        self.offsets = data[ends[1] : ends[2]].view("<u8").astype(np.int64)
        self.host_lengths = data[ends[2] : ends[3]].view("<u4")
        self.blocks = data[ends[3] : ends[4]]
        self.texts = data[ends[4] :]
        sizes = np.diff(self.offsets)
        rules = self.host_lengths > 0
        #: Lengths in bytes of the paths that occur: no other prefix need be tried.
        self.path_lengths = np.unique(sizes[rules] - self.host_lengths[rules]).tolist()

    def find(self, texts: Sequence[bytes]) -> np.ndarray:
        """The place of each string in the list, -1 if it is not there."""
        found = np.full(len(texts), -1, np.int64)
        if not len(texts) or not len(self.digests):
            return found
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        first = np.searchsorted(self.digests, wanted, "left")
        after = np.searchsorted(self.digests, wanted, "right")
        for k in np.flatnonzero(after > first):
            for place in range(first[k], after[k]):  # more than one only on a collision
                a, b = self.offsets[place], self.offsets[place + 1]
                if self.texts[a:b].tobytes() == texts[k]:
                    found[k] = place
        return found

    def text(self, place: int) -> bytes:
        return self.texts[self.offsets[place] : self.offsets[place + 1]].tobytes()


def rule_entry(verdict: str, host_: str, path_: str) -> tuple[str, str, int]:
    return f"{host_}{path_}", verdict, len(host_.encode())


def word_entry(word: str) -> tuple[str, str, int]:
    """A word is kept apart from rules by a first character that no host has."""
    return f" {word}", BLOCK, 0


def _candidates(hosts, paths, lengths: Sequence[int]) -> Iterator[tuple[int, int, bytes]]:
    """(row, host length or 0 for a word, string) of all that could be listed."""
    for row, (host_, path_) in enumerate(zip(hosts, paths, strict=True)):
        if not host_:
            continue
        for word in set(re.split("[.-]", host_)):
            yield row, 0, f" {word}".encode()
        raw_host, raw_path = host_.encode(), path_.encode()
        start = 0
        while start >= 0:
            suffix = raw_host[start:]
            for length in lengths:
                if suffix and length <= len(raw_path):
                    yield row, len(suffix), suffix + raw_path[:length]
            dot = raw_host.find(b".", start)
            start = dot + 1 if dot >= 0 else -1


def judge(listed: DigestList, hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
    """For each url the best rule of the list and whether its host has a listed word."""
    rows = list(_candidates(hosts, paths, listed.path_lengths))
    found = listed.find([text for _, _, text in rows])
    best: list[tuple | None] = [None] * len(hosts)
    words = np.zeros(len(hosts), bool)
    for k in np.flatnonzero(found >= 0):
        row, host_length, text = rows[k]
        place = found[k]
        if listed.host_lengths[place] != host_length:
            continue
        if not host_length:
            words[row] = True
            continue
        verdict = BLOCK if listed.blocks[place] else ALLOW
        rank = (len(text.decode()), host_length, text.decode(), verdict)
        if best[row] is None or rank > best[row]:
            best[row] = rank
    return pd.DataFrame(
        {
            "rule": [b and b[2] for b in best],
            "host_length": pd.array([b and b[1] for b in best], "Int32"),
            "verdict": [b and b[3] for b in best],
            "listed_word": words,
        }
    )


def _parts(entries: Iterable[tuple[str, str, int]], limit: int) -> Iterator[bytes]:
    part, size = [], 0
    for entry in entries:
        part.append(entry)
        size += len(entry[0].encode()) + 21
        if size >= limit:
            yield pack(part)
            part, size = [], 0
    yield pack(part)


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    words: Iterable[str] = HOST_WORDS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``rules`` are (verdict, host, path). A list beyond ``part_bytes`` is broadcast and probed
    in parts, the best rule carried from one to the next, so no worker holds all of it.
    """
    spark: SparkSession = ship(pages.sparkSession)
    entries = [*(rule_entry(*rule) for rule in rules), *map(word_entry, words)]
    best = F.struct(
        F.lit(0).alias("length"), F.lit(0).alias("host_length"),
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    )
    judged = pick(pages, "page_id", "url").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        best.alias("best"), F.lit(False).alias("word"),
    )
    for part in _parts(entries, part_bytes):
        judged = judged.withColumn("found", _judge_udf(spark.sparkContext.broadcast(part))("host", "path"))
        here = F.struct(
            F.coalesce(F.length("found.rule"), F.lit(0)).alias("length"),
            F.coalesce("found.host_length", F.lit(0)).alias("host_length"),
            F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"),
        )
        judged = judged.select(
            "page_id", "host", "path",
            F.when(F.col("found.rule").isNull(), F.col("best")).otherwise(F.greatest("best", here)).alias("best"),
            (F.col("word") | F.col("found.listed_word")).alias("word"),
        )
    otherwise = F.when(F.col("word"), BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", otherwise).alias("verdict")
    )


def _judge_udf(packed):
    @F.pandas_udf(JUDGED)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        listed = DigestList(packed.value)
        for hosts, paths in batches:
            yield judge(listed, hosts, paths)

    return judged
