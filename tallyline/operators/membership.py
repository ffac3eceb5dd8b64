"""A Bloom filter as a table: rows that cannot have a key of a small set are dropped where they are.

The filter is an array of 64-bit words. A key has one word and four bits in it, so building it is one
aggregate and asking it is one broadcast join. What it lets through by mistake (about one row in
a hundred) an exact join after it removes; it never drops a row whose key is in the set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.joins import BROADCAST_LIMIT_BYTES

#: Keys for each word of the filter, bits for each key, and bytes of a word as a broadcast row.
KEYS_PER_WORD = 4
BITS_PER_KEY = 4
ROW_BYTES = 48


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    drawn = F.xxhash64(F.lit("bits"), key)
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(drawn, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        for k in range(BITS_PER_KEY)
    ]
    return reduce(Column.bitwiseOR, bits)


def words_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_WORD))


def bloom_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """word, bits: the filter of the keys. A NULL key is no key."""
    asked = keys.where(F.col(key).isNotNull()).select(
        _word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("mask")
    )
    return asked.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def may_have_key(
    df: DataFrame, keys: DataFrame, key: str, count: int, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be one of the ``count`` keys of the other frame.

    Beyond ``limit`` bytes of filter all rows are returned; the exact join that follows is then
    the only one.
    """
    words = words_for(count)
    if words * ROW_BYTES > limit:
        return df
    built = F.broadcast(bloom_words(keys, key, words))
    word, mask = _word(df[key], words), _mask(df[key])
    fits = built["bits"].bitwiseAND(mask) == mask
    return df.join(built, (word == built["word"]) & fits, "left_semi")


def held_by(df: DataFrame, built: DataFrame, key: str, words: int, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether its ``key`` may be one of the filter's."""
    side = built.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    joined = df.join(F.broadcast(side), _word(F.col(key), words) == F.col("_word"), "left")
    mask = _mask(F.col(key))
    fits = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    return joined.withColumn(flag, F.col(key).isNotNull() & fits).drop("_word", "_bits")
