"""Phrase collocation mining over a prefix-free parse.

A text is a row of words with breaks where its pieces end. It is cut into chunks where its content says
so: two neighbouring tokens whose hashes agree with a modulus trigger a cut. A chunk runs from one
trigger to the end of the next, so neighbours overlap by those two tokens, and equal passages give
equal chunks wherever they stand.
The chunks of a language form a dictionary with the frequencies of the parse. Phrases are counted
inside distinct chunks only, weighted by frequency; a phrase that starts in the closing trigger
belongs to the next chunk, so each occurrence counts once. A passage that a large part of the
documents shares is read in each of them but counted once. Phrases are counted length by length: one
whose first or last words are too rare is too rare itself and never leaves its worker. Which ones
are frequent the workers ask a Bloom filter of bounded size, so the counts stay exact.

Candidates are phrases that occur often enough. Cut in two anywhere, a phrase has the score
floor(10^6 a^2 / (l r)); its worst cut counts. A candidate that mostly occurs inside a longer one is
dropped. All counts and products are exact integers (counts up to 10^12).

Defined cases: a null text is empty, a null language is ``und``; whole texts are read; repeated rows
count as often as they occur; a text without a trigger is cut after ``LONGEST`` tokens; an empty
table or one without candidates gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tallyline.llm.common import kept, pick, ship
from tallyline.operators.joins import broadcast_if_small

#: On UTF-8 bytes: capitals become small, what ends a piece becomes a line break, a tab a blank.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_MARKED = bytes(
    10 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)

#: Between two pieces stands a break, which no word can be.
BREAK = b"\n"

#: Fixed values of the contract.
MIN_COUNT = 10
COVERED_PERCENT = 50
BEST = 2_000
SCALE = 1_000_000
UNKNOWN = "und"

#: Words of the longest phrase; chunks overlap by one word less.
MOST_WORDS = 3

#: One trigger in so many pairs of tokens, and the most tokens between two cuts.
MODULUS = 32
LONGEST = 1_024

#: Words whose hash a worker remembers, chunks and phrases that it sums before it lets them go.
REMEMBERED = 300_000
HELD_CHUNKS = 100_000
HELD_PHRASES = 2_000_000

#: Chunks that are looked at together, and bits of the number of a word while they are.
SLICE = 1_000
WORD_BITS = 21

#: Most bytes of a filter of frequent phrases.
FILTER_BYTES = 16 * 1024 * 1024

#: Bytes up to which a table of frequent phrases is broadcast.
FREQUENT_BYTES = 16 * 1024 * 1024

_CHUNKS = pa.schema(
    [("lang", pa.string()), ("closed", pa.bool_()), ("chunk", pa.binary()), ("freq", pa.int64())]
)
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("freq", pa.int64())])


class _Hashes(dict):
    """Hashes of tokens, the same on every worker; forgotten all at once when they are many."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[token] = crc32(token)
        return found


def tokens_of(text: bytes) -> list[bytes]:
    """The words of a text, with a break between any two pieces."""
    pieces = filter(None, map(bytes.strip, text.translate(_MARKED).split(BREAK)))
    return list(filter(None, b" \n ".join(pieces).split(b" ")))


def cuts(tokens: list[bytes], hashes: _Hashes) -> list[int]:
    """Where chunks begin: at triggers, and ``LONGEST`` tokens after a cut at the latest."""
    overlap = MOST_WORDS - 1
    if len(tokens) <= overlap:
        return [0]
    drawn = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    pairs = _mixed(drawn[1:-overlap], drawn[2 : len(tokens) - overlap + 1])
    found = [0]
    for at in (np.flatnonzero(pairs % np.uint64(MODULUS) == 0) + 1).tolist():
        found.extend(range(found[-1] + LONGEST, at, LONGEST))
        found.append(at)
    found.extend(range(found[-1] + LONGEST, len(tokens) - overlap, LONGEST))
    return found


def chunks_of(tokens: list[bytes], hashes: _Hashes) -> tuple[list[bytes], bytes]:
    """The closed chunks, which end with the tokens that open the next one, and the last one."""
    starts = cuts(tokens, hashes)
    overlap = MOST_WORDS - 1
    closed = [
        b" ".join(tokens[start : end + overlap]) for start, end in zip(starts, starts[1:], strict=False)
    ]
    return closed, b" ".join(tokens[starts[-1] :])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of the texts with their frequencies, summed as far as a worker holds them."""
    hashes, held = _Hashes(), {}
    for batch in batches:
        texts = zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
        for lang, text in texts:
            tokens = tokens_of(text)
            if not tokens:
                continue
            closed, last = chunks_of(tokens, hashes)
            held.setdefault((lang, True), Counter()).update(closed)
            held.setdefault((lang, False), Counter())[last] += 1
            if sum(map(len, held.values())) > HELD_CHUNKS:
                yield from _released(held)
                held = {}
    yield from _released(held)


def _released(held: dict[tuple[str, bool], Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, closed), counts in held.items():
        chunks, freqs = list(counts), list(counts.values())
        for start in range(0, len(chunks), 20_000):
            part = chunks[start : start + 20_000]
            columns = [[lang] * len(part), [closed] * len(part), part, freqs[start : start + 20_000]]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, _CHUNKS.types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)


def _mixed(one: np.ndarray, other: np.ndarray | np.uint64) -> np.ndarray:
    """64-bit hashes of pairs of hashes."""
    mixed = (one * np.uint64(0x9E3779B97F4A7C15) + other) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=1))


def phrase_hashes(words: np.ndarray, lang: np.uint64 | np.ndarray, length: int) -> np.ndarray:
    """From the hashes of words, for every place that of the phrase of so many words there."""
    hashes = _mixed(words, lang)
    found = hashes[: max(len(words) - length + 1, 0)]
    for k in range(1, length):
        found = _mixed(found, hashes[k : k + len(found)])
    return found


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Four bits of a word for each hash."""
    bits = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return bits


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """``slots`` is a power of two."""
    return ((hashes >> np.uint64(24)) & np.uint64(slots - 1)).astype(np.int64)


class Filter:
    """A Bloom filter of phrases: one 64-bit word and four bits in it for each. It never misses a
    phrase that was put in, and lets few others pass."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bits = _bits(hashes)
        return self.words[_slots(hashes, len(self.words))] & bits == bits


def filter_of(frequent: DataFrame, length: int) -> Filter:
    """The filter of the frequent phrases of a length. Its size follows their number up to
    ``FILTER_BYTES``; beyond, more phrases pass that turn out too rare, and nothing is lost."""
    phrases = frequent.where(F.col("words") == length)
    slots = min(1 << max(phrases.count() // 4, 1).bit_length(), FILTER_BYTES // 8)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([_lang_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
            flat = [
                xxhash.xxh64_intdigest(word)
                for phrase in batch.column("phrase").to_pylist()
                for word in phrase.split(b" ")
            ]
            words = np.array(flat, np.uint64)
            held = phrase_hashes(words, np.repeat(langs, length), length)[::length]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_slots(held, slots)), pa.array(_bits(held).view(np.int64))],
                names=["slot", "bits"],
            )

    rows = (
        phrases.select("lang", F.col("phrase").cast("binary").alias("phrase"))
        .mapInArrow(placed, "slot long, bits long")
        .groupBy("slot")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    words = np.zeros(slots, dtype=np.uint64)
    words[rows["slot"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return Filter(words)


class _Vocabulary(dict):
    """Numbers of a language's words, shared with all languages of a worker."""

    def __init__(self, shared: _Phrases, lang: str):
        super().__init__()
        self.shared, self.lang, self.code = shared, lang, _lang_hash(lang)

    def __missing__(self, word: bytes) -> int:
        shared = self.shared
        found = self[word] = len(shared.words)
        shared.words.append(word)
        shared.langs.append(self.lang)
        if shared.known is not None:
            shared.new_hashes.append(xxhash.xxh64_intdigest(word))
            shared.new_codes.append(self.code)
        return found


class _Phrases:
    """Sums the frequencies of phrases of a length as arrays of word numbers."""

    def __init__(self, length: int, known: Filter | None):
        self.length, self.known = length, known
        self.forget()

    def forget(self) -> None:
        self.vocabularies: dict[str, _Vocabulary] = {}
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.new_hashes: list[int] = []
        self.new_codes: list[np.uint64] = []
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.frequent = np.zeros(0, dtype=bool)
        self.keys: list[np.ndarray] = []
        self.freqs: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, chunks: list[bytes], closed: np.ndarray, freqs: np.ndarray) -> None:
        """Phrases that start inside the chunks, before a closing trigger, and hold no break.

        A phrase can only be frequent if both its first and its last words are: no other is kept.
        """
        tokens = b" ".join(chunks).split(b" ")
        vocabulary = self.vocabularies.get(lang)
        if vocabulary is None:
            vocabulary = self.vocabularies[lang] = _Vocabulary(self, lang)
        ids = np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, len(tokens))
        sizes = np.fromiter((chunk.count(b" ") + 1 for chunk in chunks), np.int64, len(chunks))
        of = np.repeat(np.arange(len(chunks)), sizes)
        first = np.cumsum(sizes) - sizes
        starts = sizes - closed * (MOST_WORDS - 1)
        word = ids != vocabulary[BREAK]
        fits = word & (np.arange(len(ids)) - first[of] < starts[of])
        for k in range(1, self.length):
            fits[len(ids) - k :] = False
            fits[:-k] &= word[k:] & (of[k:] == of[:-k])
        if self.known is not None:
            frequent = self._frequent(lang, ids)
            both = frequent[:-1] & frequent[1:]
            fits[: len(both)] &= both
            fits[len(both) :] = False
        places = np.flatnonzero(fits)
        key = ids[places]
        for k in range(1, self.length):
            key = (key << WORD_BITS) | ids[places + k]
        self.keys.append(key)
        self.freqs.append(freqs[of[places]])
        self.size += len(key)

    def _frequent(self, lang: str, ids: np.ndarray) -> np.ndarray:
        """For every place whether the phrase one word shorter that starts there may be frequent.
        Single words are looked up once for all places they stand at."""
        if self.new_hashes:
            new = np.array(self.new_hashes, dtype=np.uint64)
            self.hashes = np.concatenate([self.hashes, new])
            if self.length == 2:
                held = self.known.holds(phrase_hashes(new, np.array(self.new_codes), 1))
                self.frequent = np.concatenate([self.frequent, held])
            self.new_hashes, self.new_codes = [], []
        if self.length == 2:
            return self.frequent[ids]
        return self.known.holds(phrase_hashes(self.hashes[ids], _lang_hash(lang), self.length - 1))

    def full(self, more: int) -> bool:
        """Whether phrases should be let go before so many tokens are added."""
        return self.size > HELD_PHRASES or len(self.words) + more + 1 >= 1 << WORD_BITS

    def release(self) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        freqs = np.concatenate([np.zeros(0, np.int64), *self.freqs])
        if self.length == 1:
            sums = np.zeros(len(self.words), np.int64)
            np.add.at(sums, keys, freqs)
            keys = np.flatnonzero(sums)
            sums = sums[keys]
        else:
            order = np.argsort(keys)
            keys = keys[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
            sums = np.add.reduceat(freqs[order], at) if len(at) else freqs
            keys = keys[at]
        words, langs = pa.array(self.words, pa.binary()), pa.array(self.langs, pa.string())
        for start in range(0, len(keys), 100_000):
            part = keys[start : start + 100_000]
            shifts = [WORD_BITS * k for k in reversed(range(self.length))]
            ids = [pa.array((part >> shift) & ((1 << WORD_BITS) - 1)) for shift in shifts]
            phrase = words.take(ids[0])
            if self.length > 1:
                taken = [words.take(one) for one in ids]
                phrase = pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(ids[0]),
                    phrase,
                    pa.array(sums[start : start + 100_000]),
                ],
                schema=_PHRASES,
            )
        self.forget()


def _counter(length: int, known) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts the phrases of a length; ``known`` is a broadcast filter of the frequent phrases that
    are one word shorter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _Phrases(length, known.value if known is not None else None)
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            chunks = batch.column("chunk")
            closed = batch.column("closed").to_numpy(zero_copy_only=False)
            freqs = batch.column("freq").to_numpy()
            for lang in dict.fromkeys(langs.tolist()):
                here = np.flatnonzero(langs == lang)
                for start in range(0, len(here), SLICE):
                    part = here[start : start + SLICE]
                    if phrases.full(SLICE * (LONGEST + MOST_WORDS)):
                        yield from phrases.release()
                    phrases.add(lang, chunks.take(pa.array(part)).to_pylist(), closed[part], freqs[part])
        yield from phrases.release()

    return count


def dictionary(documents: DataFrame) -> DataFrame:
    """lang, closed, chunk, freq: the distinct chunks of the parse."""
    ship(documents.sparkSession)
    texts = pick(documents, "lang", "text").select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return (
        texts.mapInArrow(_parsed, from_arrow_schema(_CHUNKS))
        .groupBy("lang", "closed", "chunk")
        .agg(F.sum("freq").alias("freq"))
    )


def frequent_phrases(chunks: DataFrame, min_count: int) -> DataFrame:
    """lang, words, phrase, freq of the phrases of up to ``MOST_WORDS`` words that occur often
    enough, length by length: the ones of a length say which longer ones need counting."""
    ship(chunks.sparkSession)
    found, known = [], None
    for length in range(1, MOST_WORDS + 1):
        counted = (
            chunks.mapInArrow(_counter(length, known), from_arrow_schema(_PHRASES))
            .withColumn("phrase", F.col("phrase").cast("string"))
            .groupBy("lang", "phrase")
            .agg(F.sum("freq").alias("freq"))
            .select("lang", F.lit(length).alias("words"), "phrase", "freq")
        )
        found.append(kept(counted.where(F.col("freq") >= min_count), "frequent"))
        if length < MOST_WORDS:
            known = chunks.sparkSession.sparkContext.broadcast(filter_of(found[-1], length))
    return reduce(DataFrame.unionByName, found)


def _exact(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(15,0))"


def _looked_up(rows: DataFrame, frequent: DataFrame, part: str, name: str) -> DataFrame:
    """The frequency of the phrase in column ``part``; a part is at least as frequent as what it
    is part of, so it is always found."""
    side = frequent.select(
        F.col("lang").alias("l_"), F.col("phrase").alias("p_"), F.col("freq").alias(name)
    )
    (side,) = broadcast_if_small(side, limit=FREQUENT_BYTES)
    met = (F.col("lang") == F.col("l_")) & (F.col(part) == F.col("p_"))
    return rows.join(side, met).drop("l_", "p_")


def candidates(frequent: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one covers."""
    phrases = frequent.where("words > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", "words", F.col("freq").alias("a"), cut).selectExpr(
        "lang", "phrase", "a", "k",
        "substring_index(phrase, ' ', k) AS first",
        "substring_index(phrase, ' ', k - words) AS rest",
    )
    cuts = _looked_up(_looked_up(cuts, frequent, "first", "l"), frequent, "rest", "r")
    score = F.expr(
        f"CAST({SCALE} AS DECIMAL(7,0)) * ({_exact('a')} * {_exact('a')}) div ({_exact('l')} * {_exact('r')})"
    )
    scored = cuts.select(
        "lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"),
        F.lit(None).cast("long").alias("cover"),
    )

    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, n), ' '))))"
    )
    covers = phrases.where("words > 2").select(
        "lang",
        F.explode(inner).alias("phrase"),
        F.lit(None).cast("long").alias("a"),
        F.lit(None).cast(scored.schema["cut"].dataType).alias("cut"),
        F.col("freq").alias("cover"),
    )
    return (
        scored.unionByName(covers)
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("a"), F.min("cut").alias("cut"), F.max("cover").alias("cover"))
        .where(F.col("a").isNotNull())
        .where(F.coalesce(100 * F.col("cover") < covered_percent * F.col("a"), F.lit(True)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def best(found: DataFrame, rows: int = BEST) -> DataFrame:
    """The first rows of each language with their rank.

    Classes of scores are counted, and what is below the class of the last rank is dropped where
    it is. The rest is ranked in parts and then once more, so neither a language with most of the
    candidates nor ties put more than the rows asked for of each part into one task.
    """
    score_class = F.expr(f"score div {SCALE // 1000}")
    above = F.sum("in_class").over(
        Window.partitionBy("lang").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    )
    classes = found.groupBy("lang", score_class.alias("class")).agg(F.count(F.lit(1)).alias("in_class"))
    lowest = (
        classes.withColumn("above", F.coalesce(above, F.lit(0)))
        .where(F.col("above") < rows)
        .groupBy(F.col("lang").alias("l_"))
        .agg(F.min("class").alias("lowest"))
    )
    (lowest,) = broadcast_if_small(lowest, limit=FREQUENT_BYTES)
    near = found.join(lowest, F.col("lang") == F.col("l_")).where(score_class >= F.col("lowest"))

    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    first = near.withColumn("part", part).withColumn("in_part", in_part).where(F.col("in_part") <= rows)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = first.withColumn("rank", rank).where(F.col("rank") <= rows)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "score")


def collocations(documents: DataFrame, min_count: int = MIN_COUNT, rows: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language."""
    chunks = kept(dictionary(documents), "chunks")
    frequent = frequent_phrases(chunks, min_count)
    found = kept(candidates(frequent), "candidates")
    # Words that start inside a chunk: its tokens without breaks and without a closing trigger.
    tokens = F.split(F.col("chunk").cast("string"), " ")
    inside = F.when(F.col("closed"), F.slice(tokens, 1, F.size(tokens) - (MOST_WORDS - 1))).otherwise(tokens)
    word_count = F.size(F.filter(inside, lambda token: token != BREAK.decode()))
    words = chunks.groupBy(F.col("lang").alias("l_")).agg(F.sum(F.col("freq") * word_count).alias("n"))
    (words,) = broadcast_if_small(words, limit=FREQUENT_BYTES)
    return (
        best(found, rows)
        .join(words, F.col("lang") == F.col("l_"))
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
