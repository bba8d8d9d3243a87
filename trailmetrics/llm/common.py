"""What the corpus operators share.

Columns whose names begin with ``__llm_`` are reserved for the operators; every
other column of an input may have any name and is passed on untouched.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words and what ends a line.
SPACES = " \t\n\x0b\x0c\r"
SPACED_WORD = r"[^\x20\x09-\x0D]+"
# In a text in lower case: all but 00-2F, 3A-60 and 7B-7F (Java matches a listed
# class many times faster than the negation of a list).
ALNUM_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
# The same in any text, to count words without changing their case.
ALNUM_WORD_ANY_CASE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"

ID, TEXT_HASH = "__llm_id", "__llm_text_hash"
_NO_ID = -(2**63)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    # Plain ASCII text takes the fast way; both give the same.
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(text.rlike(r"[^\x00-\x7F]"), other).otherwise(F.lower(text))


def with_row_key(documents: DataFrame) -> DataFrame:
    """Name each row by its id and the hash of its text.

    Rows that repeat both are alike in all that the operators derive, so they
    may share a key; a null id gets a value of its own below all others.
    """
    return documents.withColumns(
        {
            ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
            TEXT_HASH: F.xxhash64("text"),
        }
    )


def hash_pair(value: Column) -> list[Column]:
    """128 bits that stand for a value."""
    return [
        F.xxhash64(value).alias("__llm_h1"),
        F.xxhash64(F.lit("second"), value).alias("__llm_h2"),
    ]


PAIR = ["__llm_h1", "__llm_h2"]
