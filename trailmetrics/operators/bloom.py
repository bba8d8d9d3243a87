"""A Bloom filter of ids, which drops rows before a join shuffles them.

The filter is an array of 64-bit words that aggregates build; tests of it are plain
column expressions. A row that passes may still not be among the ids, so an exact
join follows. Null is an id like any other.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# With 12 bits and 4 hashes an id, about 6 rows of 1,000 pass by mistake; a power of
# two is taken, so they may be fewer.
BITS_PER_ID = 12
HASHES = 4
# 8 MB, which every task gets.
MAX_BITS = 2**26


def bits_for(ids: int) -> int | None:
    """The bits of a filter for so many ids; None if it would be too large."""
    bits = max(64, 1 << (BITS_PER_ID * ids - 1).bit_length()) if ids else 64
    return bits if bits <= MAX_BITS else None


def _places(key: Column, bits: int) -> list[Column]:
    first = F.pmod(F.xxhash64(key), F.lit(bits))
    step = F.pmod(F.xxhash64(F.lit("step"), key), F.lit(bits))
    return [F.pmod(first + i * step, F.lit(bits)) for i in range(HASHES)]


def words(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the filter of the ids in the column `key`, an array of longs.

    The words are put together in each task before they are shuffled.
    """
    place = F.col("place")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    empty = ids.sparkSession.range(bits // 64).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask")
    )
    parts = (
        ids.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
        .select(F.floor(place / 64).alias("word"), mask.alias("mask"))
        .unionAll(empty)
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    in_order = F.sort_array(F.collect_list(F.struct("word", "mask")))
    return parts.agg(in_order["mask"].alias("words"))


def might_contain(filter_words: DataFrame, key: Column, bits: int) -> Column:
    """False only where `key` is not among the ids of the filter."""
    found = filter_words.scalar()

    def is_set(place: Column) -> Column:
        word = F.get(found, F.floor(place / 64).cast("int"))
        return F.getbit(word, (place % 64).cast("int")) == 1

    return reduce(and_, [is_set(place) for place in _places(key, bits)])


def prefiltered(rows: DataFrame, ids: DataFrame, key: str, expected: int) -> DataFrame:
    """`rows` without most of those whose `key` is not among the ids.

    `ids` should be a written table; `expected` says how many rows it has. Where the
    filter would be larger than `MAX_BITS`, all rows are returned.
    """
    bits = bits_for(expected)
    if bits is None:
        return rows
    return rows.where(might_contain(words(ids, key, bits), F.col(key), bits))
