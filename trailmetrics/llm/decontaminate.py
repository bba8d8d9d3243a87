"""Find passages of benchmark items in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.common import (
    ALNUM_WORD,
    ALNUM_WORD_ANY_CASE,
    ID,
    TEXT_HASH,
    lower_ascii,
    with_row_key,
)
from trailmetrics.operators import bloom
from trailmetrics.runtime import Scratch

_WORDS, _NAME, _LENGTH = "__llm_words", "__llm_name", "__llm_length"
_WINDOW, _START, _ITEM = "__llm_window", "__llm_start", "__llm_item"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all that is not ASCII, in lower case."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(ALNUM_WORD), F.lit(0))


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, item) for each run of `size` words of an item.

    An item of fewer words, but not none, is one window.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias(_ITEM), words(F.col("text")).alias(_WORDS)
    ).where(F.size(_WORDS) > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size(_WORDS) - size + 1, F.lit(1)))
    return (
        items.select(_ITEM, _WORDS, F.explode(starts).alias(_START))
        .select(_ITEM, F.slice(_WORDS, F.col(_START), size).alias(_WINDOW))
        .distinct()
    )


def _name(hashes: Column) -> Column:
    """The hash of a run of words, from the hashes of its words."""
    return F.xxhash64(hashes)


def _hashes(run: Column) -> Column:
    return F.transform(run, lambda word: F.xxhash64(word))


def named_windows(windows: DataFrame) -> DataFrame:
    """Each distinct window with its hash and its number of words."""
    return (
        windows.select(_WINDOW)
        .distinct()
        .select(_WINDOW, _name(_hashes(F.col(_WINDOW))).alias(_NAME), F.size(_WINDOW).alias(_LENGTH))
    )


def occurrences(documents: DataFrame, lookup: DataFrame, broadcast_rows: int) -> DataFrame:
    """(row key, start, length, window) wherever a window stands in a document.

    From each word of a document on, the hash of as many words as a window has is
    looked up, once for each length that windows have (most have the full one, and
    none has more); where it is met, the words are compared. Up to
    `broadcast_rows` windows are sent to every executor. More are not: a Bloom
    filter of their hashes drops most places, and the rest are joined. Either way
    the texts are read once.
    """
    count = lookup.count()
    lengths = sorted(row[0] for row in lookup.select(_LENGTH).distinct().collect()) or [1]
    placed = (
        with_row_key(documents.select("doc_id", "text"))
        .select(ID, TEXT_HASH, words(F.col("text")).alias(_WORDS))
        .withColumn("__llm_hashes", _hashes(F.col(_WORDS)))
        .select(
            ID,
            TEXT_HASH,
            _WORDS,
            "__llm_hashes",
            F.posexplode("__llm_hashes").alias(_START, "__llm_first"),
        )
        .withColumn(
            _LENGTH,
            F.explode(F.array(*map(F.lit, lengths))) if len(lengths) > 1 else F.lit(lengths[0]),
        )
        .where(F.col(_START) + F.col(_LENGTH) <= F.size(_WORDS))
        .withColumn(_NAME, _name(F.slice("__llm_hashes", F.col(_START) + 1, F.col(_LENGTH))))
    )
    run = F.slice(_WORDS, F.col(_START) + 1, F.col(_LENGTH))
    if count <= broadcast_rows:
        met = placed.select(ID, TEXT_HASH, _START, _WORDS, _LENGTH, _NAME)
        held = F.broadcast(lookup.withColumnRenamed(_LENGTH, "__llm_own_length"))
        same = (met[_NAME] == held[_NAME]) & (F.col(_LENGTH) == F.col("__llm_own_length"))
        found = met.join(held, same & (run == F.col(_WINDOW)))
    else:
        near = bloom.prefiltered(placed, lookup, _NAME, count)
        met = near.select(ID, TEXT_HASH, _START, _LENGTH, _NAME, run.alias("__llm_run"))
        found = met.join(lookup, [_NAME, _LENGTH]).where(F.col("__llm_run") == F.col(_WINDOW))
    return found.select(ID, TEXT_HASH, _START, _LENGTH, _WINDOW)


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch,
    size: int = 13,
    percent: int = 5,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """One row per row of `documents`: what it shares with `benchmark`.

    Returns all columns of `documents` and, as `__llm_n_words`, `__llm_n_hit`,
    `__llm_items` and `__llm_contaminated`: its words, its words inside any
    window of an item, the sorted ids (as text) of the items with such windows,
    and whether hit words are at least `percent` of all.

    A null or empty text has no words and is clean. Items without words match
    nothing; a null item_id is not listed but its windows count. Rows that share
    a doc_id are judged one by one. A very long text is one row, of 8 bytes a word
    beside its words. Empty tables give no rows or no hits.
    """
    windows = scratch.write(item_windows(benchmark, size), "item_windows")
    lookup = scratch.write(named_windows(windows), "named_windows")
    hits = scratch.write(occurrences(documents, lookup, broadcast_rows), "benchmark_hits")
    row = [ID, TEXT_HASH]
    covered = (
        hits.select(
            *row,
            F.explode(F.sequence(_START, F.col(_START) + F.col(_LENGTH) - 1)).alias("__llm_at"),
        )
        .groupBy(*row)
        .agg(F.count_distinct("__llm_at").alias("__llm_n_hit"))
    )
    items = (
        hits.select(*row, _WINDOW)
        .distinct()
        .join(windows, _WINDOW)
        .groupBy(*row)
        .agg(F.sort_array(F.collect_set(_ITEM)).alias("__llm_items"))
    )
    n_words, n_hit = F.col("__llm_n_words"), F.col("__llm_n_hit")
    return (
        with_row_key(documents)
        .withColumn(
            "__llm_n_words",
            F.coalesce(F.regexp_count("text", F.lit(ALNUM_WORD_ANY_CASE)), F.lit(0)).cast("long"),
        )
        .join(covered.join(items, row, "left"), row, "left")
        .drop(*row)
        .withColumn("__llm_n_hit", F.coalesce(n_hit, F.lit(0)).cast("long"))
        .withColumn("__llm_items", F.coalesce("__llm_items", F.array().cast("array<string>")))
        .withColumn("__llm_contaminated", (n_hit > 0) & (n_hit * 100 >= n_words * percent))
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents that are not contaminated, whole."""
    judged = contamination(documents, benchmark, scratch)
    return judged.where(~F.col("__llm_contaminated")).select(*[f"`{c}`" for c in documents.columns])
