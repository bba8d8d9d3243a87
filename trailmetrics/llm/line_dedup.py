"""Drop lines that many documents repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.common import (
    ID,
    PAIR,
    SPACES,
    TEXT_HASH,
    hash_pair,
    lower_ascii,
    with_row_key,
)
from trailmetrics.runtime import Scratch

_POSITION, _DROPPED, _LINES = "__llm_position", "__llm_dropped", "__llm_lines"


def split_lines(text: Column) -> Column:
    """The lines of a text; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(documents: DataFrame, min_length: int) -> DataFrame:
    """(row key, position, key hash) of each line whose key is long enough.

    The key is the line without white space at its ends, in lower case (A-Z
    only). Lines that are too short as they stand are left out first.
    """
    lines = with_row_key(documents.select("doc_id", "text")).select(
        ID, TEXT_HASH, F.posexplode(split_lines(F.col("text"))).alias(_POSITION, "__llm_line")
    )
    key = F.col("__llm_key")
    return (
        lines.where(F.length("__llm_line") >= min_length)
        .withColumn("__llm_key", lower_ascii(F.btrim("__llm_line", F.lit(SPACES))))
        .where(F.length(key) >= min_length)
        .select(ID, TEXT_HASH, _POSITION, *hash_pair(key))
    )


def repeated_keys(keys: DataFrame, min_documents: int) -> DataFrame:
    """Keys of at least `min_documents` documents, with the largest id of them.

    Spark deals the rows out by key and document first and counts per key after
    that, so a line of a third of all documents is counted by many tasks.
    """
    return (
        keys.groupBy(*PAIR)
        .agg(F.count_distinct(ID).alias("__llm_documents"), F.max(ID).alias("__llm_last"))
        .where(F.col("__llm_documents") >= min_documents)
        .select(*PAIR, "__llm_last")
    )


def dedup_lines(
    documents: DataFrame,
    scratch: Scratch,
    min_length: int = 40,
    min_documents: int = 5,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`documents` with the repeated lines taken out of `text`.

    A line goes if its key has at least `min_length` code points, stands in at
    least `min_documents` documents, and the document is not the one with the
    largest doc_id that holds it. Keys are compared by 128 bits of hash. The
    other lines stay in their order, joined by a newline.

    A null text counts as one empty line, and becomes an empty text. Rows that
    share a doc_id are one document for the counts, and each keeps or loses its
    own lines; a null doc_id is a document below all others. A very long text is
    split whole; its lines are rows of their own where keys are counted, and one
    row where they are put together again. Other columns pass unchanged; `counts`
    names two more, for the lines before and the lines dropped. An empty table
    stays empty.
    """
    keys = scratch.write(line_keys(documents, min_length), "line_keys")
    # Written down, so that adaptive execution can split the lines of one key.
    repeated = scratch.write(repeated_keys(keys, min_documents), "repeated_keys")
    dropped = (
        keys.join(repeated, PAIR)
        .where(F.col(ID) < F.col("__llm_last"))
        .groupBy(ID, TEXT_HASH)
        .agg(F.collect_set(_POSITION).alias(_DROPPED))
    )
    lines = F.col(_LINES)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(_DROPPED))
    text = F.when(F.col(_DROPPED).isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda position: F.get(lines, position)), "\n")
    )
    joined = (
        with_row_key(documents)
        .join(dropped, [ID, TEXT_HASH], "left")
        .withColumn(_LINES, split_lines(F.col("text")))
    )
    # Where a document lost all lines, the joined text is empty.
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in documents.columns]
    if counts:
        columns = [c for c, name in zip(columns, documents.columns) if name not in counts]
        columns.append(F.size(lines).cast("long").alias(counts[0]))
        columns.append(
            F.coalesce(F.size(_DROPPED), F.lit(0)).cast("long").alias(counts[1])
        )
    return joined.select(*columns)
