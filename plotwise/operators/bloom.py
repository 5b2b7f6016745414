"""A Bloom filter over a column's values, as rows that merge and as bits a scan can test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 10
HASHES = 5  # with ten bits a key about one in a hundred others passes
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 28  # at most 32 MB go to the tasks
WORD = 64


def bits_for(keys: int) -> int | None:
    """Bits of a filter for so many keys, a power of two; None if that is more than the bound."""
    bits = max(LEAST_BITS, 1 << max(keys * BITS_PER_KEY - 1, 1).bit_length())
    return bits if bits <= MOST_BITS else None


def filter_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """word, bits of the keys' filter; words fold in every input task."""
    hashed = keys.where(F.col(key).isNotNull()).withColumns(_hashes(key))
    each = hashed.select(F.explode(F.array(*_stepped(bits))).alias("place"))
    return _folded(each.select((F.col("place") / WORD).cast("long").alias("word"), _bit().alias("bits")))


def _hashes(key: str) -> dict[str, Column]:
    return {"_one": F.xxhash64(key), "_two": F.xxhash64(key, F.lit("step")).bitwiseOR(F.lit(1))}


def _stepped(bits: int) -> list[Column]:
    """Places of a key's bits: one hash, stepped by the other. Only the low bits count, so nothing overflows."""
    low = F.lit(bits - 1)
    return [(F.col("_one").bitwiseAND(low) + F.col("_two").bitwiseAND(low) * i).bitwiseAND(low) for i in range(HASHES)]


def _bit() -> Column:
    return F.expr(f"shiftleft(1L, cast(place % {WORD} as int))")


def _folded(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def merged(*filters: DataFrame) -> DataFrame:
    """Filters of one size as one: that of all their keys."""
    out = filters[0]
    for other in filters[1:]:
        out = out.unionByName(other)
    return _folded(out)


def where_may_hold(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be among the filter's; none that is goes.

    The filter is one value of bits / 8 bytes, worked out before the scan and tested in it: no
    row is shuffled for it.
    """
    spark = df.sparkSession
    every = spark.range(bits // WORD).select(F.col("id").alias("word")).join(words, "word", "left")
    dense = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    value = every.agg(F.transform(dense, lambda w: w["bits"]).alias("filter")).scalar()
    hashed = df.withColumns(_hashes(key))
    held = F.lit(True)
    for place in _stepped(bits):
        word = F.get(value, (place / WORD).cast("int"))
        held = held & (F.call_function("bit_get", word, (place % WORD).cast("int")) == 1)
    return hashed.where(F.col(key).isNotNull() & held).drop("_one", "_two")
