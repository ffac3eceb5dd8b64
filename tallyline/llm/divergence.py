"""Source divergence audit: how the term shares of every two sources of a language differ.

Terms are counted once by (lang, source, term), in one shuffle that brings together all that a
language has of a term. Terms in enough documents of a language form its vocabulary, are numbered
where they were counted and dealt into blocks of bounded size, so a group is a sorted array of
(term id, count) for each block in which it has any term. For every unordered pair
of groups of a language and every block one task gets both arrays, finds the terms of the shorter
one in the longer one by galloping, and prices shared and one-sided terms both ways. Terms that
neither group has all have the same price, so they are only counted.

A share is p = 1 + floor(10^9 (count + 1) / (N + V)), the price of a term for a group with share p
against one with share q is floor((p - q)^2 / q). Integers alone are used; a count of words below
9 * 10^15 is exact.

Defined cases: null text, lang and source count as empty; every (lang, source) that occurs is a
group, also without terms; without a vocabulary all values are 0; whole texts are read; repeated
rows count as several documents. No task holds more than a block of two groups, and what a hot
group or term has is summed where its rows are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import kept, pick, ship
from tallyline.operators.joins import broadcast_if_small

#: A term is a run of letters A to Z and of everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

#: The same on UTF-8 bytes: capitals become small, what no term holds becomes a blank.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)

SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200

#: Terms that a block is meant to hold, the buckets of hashes that blocks are made of, and the
#: bytes of documents that a worker sums at once.
BLOCK_TERMS = 8_192
BUCKETS = 65_536
HELD_BYTES = 16 * 1024 * 1024

#: Bytes up to which the table of groups is broadcast.
GROUP_BYTES = 16 * 1024 * 1024

#: Needles that one galloping step brackets together.
STRIDE = 256

_COUNTED = "lang string, source string, term binary, count long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and document counts of terms by group; the empty term stands for the group."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > HELD_BYTES:
            yield from _summed(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from _summed(held)


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in a row, and which text each one is of."""
    _, offsets, letters = texts.buffers()
    letters = pa.py_buffer((letters.to_pybytes() if letters else b"").translate(_LETTERS))
    texts = pa.Array.from_buffers(
        pa.string(), len(texts), [None, offsets, letters], offset=texts.offset
    )
    split = pc.ascii_split_whitespace(texts)
    terms, of = split.flatten(), pc.list_parent_indices(split)
    there = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(there), of.filter(there).to_numpy().astype(np.int64)


def _summed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are ranked by group, so that of all (term, rank of its text) in order those of one
    term and group are neighbours, and among them those of one text."""
    whole = pa.Table.from_batches(batches).combine_chunks()
    langs, sources = (
        whole.column(name).combine_chunks().cast(pa.string()).dictionary_encode()
        for name in ("lang", "source")
    )
    group_of = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary)
    group_of += sources.indices.to_numpy()
    ranked = np.argsort(group_of, kind="stable")
    groups = group_of[ranked]
    rank = np.empty(len(ranked), dtype=np.int64)
    rank[ranked] = np.arange(len(ranked))

    terms, of = _terms(whole.column("text").combine_chunks().cast(pa.binary()))
    terms = terms.dictionary_encode()
    bits = len(ranked).bit_length()
    found = terms.indices.to_numpy().astype(np.int64) << bits
    found |= rank[of]
    found.sort()
    term, group = found >> bits, groups[found & ((1 << bits) - 1)]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1])
    starts = np.flatnonzero(first)
    new_text = np.ones(len(found), dtype=np.int64)
    new_text[1:] = found[1:] != found[:-1]
    docs = np.add.reduceat(new_text, starts) if len(starts) else starts
    counts = np.diff(starts, append=len(found))
    yield from _rows(
        (langs.dictionary, sources.dictionary), group[starts],
        terms.dictionary.cast(pa.binary()).take(pa.array(term[starts])), counts, docs,
    )
    groups = np.unique(groups)
    none = np.zeros(len(groups), dtype=np.int64)
    empty = pa.array([b""] * len(groups), pa.binary())
    yield from _rows((langs.dictionary, sources.dictionary), groups, empty, none, none)


def _rows(
    names: tuple[pa.Array, pa.Array],
    group: np.ndarray,
    terms: pa.Array,
    counts: np.ndarray,
    docs: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    langs, sources = names
    for start in range(0, len(group), 50_000):
        part = slice(start, start + 50_000)
        lang, source = np.divmod(group[part], len(sources))
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(lang)),
                sources.take(pa.array(source)),
                terms[part],
                pa.array(counts[part], pa.int64()),
                pa.array(docs[part], pa.int64()),
            ],
            names=["lang", "source", "term", "count", "docs"],
        )


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, bucket, source, term, count, docs; a row with an empty term for every group.

    A worker has summed its rows already, so they are dealt by language and bucket of hashes
    before Spark sums them: all that is asked of a term later is where it was summed.
    """
    ship(documents.sparkSession)
    docs = pick(documents, "lang", "source", "text").na.fill("")
    return (
        docs.withColumn("text", F.col("text").cast("binary"))
        .mapInArrow(_counted, _COUNTED)
        .withColumn("term", F.col("term").cast("string"))
        .withColumn("bucket", F.expr(f"CAST(pmod(xxhash64(term), {BUCKETS}) AS INT)"))
        .repartition("lang", "bucket")
        .groupBy("lang", "bucket", "source", "term")
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    )


def numbered(counted: DataFrame, min_documents: int) -> DataFrame:
    """lang, bucket, source, term, count of the vocabulary, and of each term its number, its count
    in the language and, in one of its rows only, ``head``. Rows of the empty term stay."""
    term = Window.partitionBy("bucket", "lang", "term")
    order = Window.partitionBy("bucket", "lang").orderBy("term")
    return (
        counted.withColumn("lang_count", F.sum("count").over(term))
        .withColumn("lang_docs", F.sum("docs").over(term))
        .withColumn("head", F.col("source") == F.min("source").over(term))
        .withColumn("place", F.dense_rank().over(order))
        .where((F.col("lang_docs") >= min_documents) | (F.col("term") == ""))
        .withColumn("id", F.expr(f"CAST(place AS BIGINT) * {BUCKETS} + bucket"))
        .drop("docs", "lang_docs", "place")
    )


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in steps of three digits."""
    quotient, rest = np.divmod(counts.astype(np.int64) + 1, total)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + step
    return quotient + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``short`` stands in the sorted ``long``, or -1.

    From where the last needles ended the reach doubles until it holds the next ones, which are
    then searched between: few needles pass a long array in few steps.
    """
    found = np.full(len(short), -1, dtype=np.int64)
    low = 0
    for start in range(0, len(short), STRIDE):
        needles = short[start : start + STRIDE]
        reach = 1
        while low + reach < len(long) and long[low + reach] < needles[-1]:
            reach *= 2
        window = long[low : low + reach + 1]
        at = np.searchsorted(window, needles)
        there = at < len(window)
        there[there] = window[at[there]] == needles[there]
        found[start : start + STRIDE][there] = low + at[there]
        low += int(at[-1])
        if low >= len(long):
            break
    return found


def merge(
    one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], totals: tuple[int, int]
) -> tuple[int, int, int]:
    """Of two sorted arrays of ids with their counts: the price of one against the other, of the
    other against one, and how many terms either has."""
    if len(one[0]) > len(other[0]):
        there, here, union = merge(other, one, totals[::-1])
        return here, there, union
    (ids, counts), (other_ids, other_counts) = one, other
    at = gallop(ids, other_ids)
    both = at >= 0
    alone = np.ones(len(other_ids), dtype=bool)
    alone[at[both]] = False
    matched = np.zeros(len(ids), dtype=np.int64)
    matched[both] = other_counts[at[both]]
    unmatched = np.zeros(np.count_nonzero(alone), dtype=np.int64)
    p = shares(np.concatenate([counts, unmatched]), totals[0])
    q = shares(np.concatenate([matched, other_counts[alone]]), totals[1])
    return int(prices(p, q).sum()), int(prices(q, p).sum()), len(p)


_PRICED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("lang", "one", "other")]
    + [T.StructField(name, T.LongType()) for name in ("there", "back", "shown")]
)


def _array(side: pa.Table, name: str) -> np.ndarray:
    if not side.num_rows:
        return np.zeros(0, dtype=np.int64)
    return side.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _priced(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
    """A pair task: one block of two groups, either of which may have nothing there."""
    any_side = one if one.num_rows else other
    totals = tuple(any_side.column(name)[0].as_py() for name in ("total_one", "total_other"))
    result = merge(
        (_array(one, "ids"), _array(one, "counts")),
        (_array(other, "ids"), _array(other, "counts")),
        totals,
    )
    row = [*(part.as_py() for part in key[:3]), *result]
    types = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.Table.from_arrays(
        [pa.array([value], kind) for value, kind in zip(row, types, strict=True)],
        names=_PRICED.names,
    )


def _share(count: str, total: str) -> Column:
    """A term's share as ``shares`` gives it, in Spark's exact integers."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(19,0)) div {total}")


def _price(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _same_lang(left: DataFrame, right: DataFrame) -> DataFrame:
    (right,) = broadcast_if_small(right, limit=GROUP_BYTES)
    return left.join(right, "lang")


def audit(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: the other sources of the language by how far the source is from each of them.
    ``term``: the terms that the source has a larger share of than its language, the dearest
    ``top_terms`` of them.
    """
    counted = kept(numbered(term_counts(documents), min_documents), "terms")
    occurring = counted.where("term <> ''")
    a_term = F.col("head") & (F.col("term") != "")
    sums = counted.groupBy("lang", "source").agg(
        F.sum("count").alias("words_here"),
        F.count_if(a_term).alias("terms"),
        F.sum(F.when(a_term, F.col("lang_count")).otherwise(0)).alias("words"),
    )
    sums = kept(sums, "sums")
    langs = sums.groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("words").alias("words"))
    groups = (
        sums.select("lang", "source", "words_here")
        .join(langs, "lang")
        .selectExpr(
            "lang", "source", "terms", "words_here + terms AS total", "words + terms AS lang_total"
        )
    )
    groups = kept(groups, "groups")
    block = F.expr(f"pmod(bucket, terms div {BLOCK_TERMS} + 1)")
    dealt = _same_lang(occurring, langs).withColumn("block", block)
    return _pair_part(dealt, groups).unionByName(_term_part(occurring, groups, top_terms))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _pair_part(occurring: DataFrame, groups: DataFrame) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct("id", "count")))
    arrays = (
        occurring.groupBy("lang", "source", "block")
        .agg(entries.alias("entries"))
        .selectExpr("lang", "source", "block", "entries.id AS ids", "entries.count AS counts")
    )
    arrays = kept(arrays, "arrays")
    one = groups.selectExpr("lang", "source AS one", "total AS total_one", "terms")
    other = groups.selectExpr("lang", "source AS other", "total AS total_other")
    pairs = kept(_same_lang(one, other).where("one < other"), "pairs")

    task = ["lang", "one", "other", "block"]
    dealt = pairs.select("lang", "one", "other", "total_one", "total_other")
    carried = [*task, "ids", "counts", "total_one", "total_other"]

    def side(name: str) -> DataFrame:
        """The arrays of every pair's ``one`` or ``other``, in columns of their own."""
        joined = arrays.withColumnRenamed("source", name).join(dealt, ["lang", name])
        return joined.select([F.col(column).alias(column) for column in carried])

    priced = (
        side("one")
        .groupBy(*task)
        .cogroup(side("other").groupBy(*task))
        .applyInArrow(_priced, _PRICED)
        .groupBy("lang", "one", "other")
        .agg(*[F.sum(name).alias(name) for name in ("there", "back", "shown")])
    )
    absent = (
        pairs.join(priced, ["lang", "one", "other"], "left")
        .na.fill(0, ["there", "back", "shown"])
        .withColumn("p", F.expr(f"1 + {SCALE} div nullif(total_one, 0)"))
        .withColumn("q", F.expr(f"1 + {SCALE} div nullif(total_other, 0)"))
        .withColumn("absent", F.col("terms") - F.col("shown"))
    )

    def way(source: str, item: str, found: str, p: str, q: str) -> Column:
        rest = F.when(F.col("absent") > 0, F.col("absent") * _price(p, q)).otherwise(0)
        return F.struct(
            F.col(source).alias("source"), F.col(item).alias("item"), (F.col(found) + rest).alias("value")
        )

    ways = F.explode(
        F.array(way("one", "other", "there", "p", "q"), way("other", "one", "back", "q", "p"))
    )
    rows = absent.select("lang", ways.alias("way")).select(
        "lang", "way.source", F.lit("pair").alias("part"), "way.item", "way.value"
    )
    return _ranked(rows)


def _term_part(occurring: DataFrame, groups: DataFrame, top_terms: int) -> DataFrame:
    (groups,) = broadcast_if_small(groups, limit=GROUP_BYTES)
    priced = (
        occurring.join(groups, ["lang", "source"])
        .withColumn("p", _share("count", "total"))
        .withColumn("q", _share("lang_count", "lang_total"))
        .where("p > q")
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            _price("p", "q").alias("value"),
        )
    )
    return _ranked(priced).where(F.col("rank") <= top_terms)
