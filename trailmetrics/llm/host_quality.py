"""Drop documents that fail quality rules, and documents of hosts that mostly fail.

Each text is measured by itself. Failures of each rule are summed by host, a beta
prior is fitted to the hosts' rates by their moments, and each host's rate is
shrunk towards it: a host with few documents needs more than a few failures.
Documents of a host whose shrunk rate is too high go with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.words import WordHashes, runs
from trailmetrics.runtime import Scratch

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
# What is not the first byte of a code point.
_CONTINUED = bytes(range(0x80, 0xC0))
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_ROWS = 500


def _name(measure: str) -> str:
    return f"__llm_{measure}"


def _repeated_words(hashes: np.ndarray) -> int:
    """Words in windows that occur more than once."""
    if len(hashes) <= WINDOW:
        return 0
    windows = runs(hashes, WINDOW)
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(hashes), bool)
    for i in range(WINDOW):
        covered[i : i + len(windows)] |= twice
    return int(covered.sum())


def measure(text: bytes | None, known: WordHashes) -> tuple[int, ...]:
    """The measures of one text in UTF-8, in the order of `MEASURES`; of null, all 0."""
    text = text or b""
    words = text.split()
    lines = Counter(line for line in text.split(b"\n") if line.strip())
    return (
        len(words),
        len(text.translate(None, _SPACES + _CONTINUED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        lines.total(),
        lines.total() - len(lines),
        _repeated_words(known.of(words)),
    )


def measured(documents: DataFrame, carried: list[str]) -> DataFrame:
    """The columns `carried` of each row and the measures of its text."""
    schema = documents.select(*[f"`{name}`" for name in carried]).schema
    for name in MEASURES:
        schema = schema.add(_name(name), "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                found = [measure(text.as_py(), known) for text in part.column(0)]
                columns = [pa.array(column, pa.int64()) for column in zip(*found)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *columns], names=schema.names
                )

    given = documents.select(
        F.col("text").cast("binary").alias("__llm_text"), *[f"`{name}`" for name in carried]
    )
    return given.mapInArrow(run, schema)


def base_rules() -> dict[str, Column]:
    """Rules that judge a document, whatever its host."""
    words, repeated = F.col(_name("n_words")), F.col(_name("n_repeat_words"))
    return {"few_words": words < 10, "repeated_words": 100 * repeated > 20 * words}


def host_rules() -> dict[str, Column]:
    """Rules that count against a host: the base rules, and three that alone drop no document."""
    words = F.col(_name("n_words"))
    chars = F.col(_name("word_chars"))
    return base_rules() | {
        "many_symbols": 10 * F.col(_name("n_symbols")) > words,
        "dup_lines": 10 * F.col(_name("n_dup_lines")) > 3 * F.col(_name("n_lines")),
        "word_length": ~chars.between(3 * words, 12 * words),
    }


def host_rates(judged: DataFrame, host: str, rules: dict[str, Column]) -> DataFrame:
    """(__llm_host, __llm_n, rate_<rule>...): each host's failure rates after shrinkage.

    The prior of a rule is the beta distribution whose mean is the rate over all
    documents and whose variance is what the hosts' rates vary by, beyond what
    their sizes explain. Its weight lies between 1 document and all there are.
    """
    counts = (
        judged.where(F.col(f"`{host}`").isNotNull())
        .groupBy(F.col(f"`{host}`").alias("__llm_host"))
        .agg(F.count("*").alias("__llm_n"), *[F.count_if(r).alias(k) for k, r in rules.items()])
    )
    n, total = F.col("__llm_n"), F.col("__llm_total")
    sums = counts.agg(
        F.count("*").alias("__llm_hosts"),
        F.sum(n).alias("__llm_total"),
        F.sum(n.cast("double") * n).alias("__llm_squares"),
        *[F.sum(k).alias(f"all_{k}") for k in rules],
        *[F.sum(F.col(k).cast("double") * F.col(k) / n).alias(f"spread_{k}") for k in rules],
    )

    def strength(k: str) -> Column:
        mean = F.col(f"all_{k}") / total
        noise = mean * (1 - mean)
        between = F.col(f"spread_{k}") - F.col(f"all_{k}") * mean
        extra = F.try_divide(
            between - (F.col("__llm_hosts") - 1) * noise, total - F.col("__llm_squares") / total
        )
        alike = F.coalesce(F.try_divide(extra, noise), F.lit(0.0))
        return 1 / F.least(F.greatest(alike, 1 / (total + 1)), F.lit(0.5)) - 1

    prior = sums.select(
        *[(F.col(f"all_{k}") / total).alias(f"mean_{k}") for k in rules],
        *[strength(k).alias(f"strength_{k}") for k in rules],
    )

    def shrunk(k: str) -> Column:
        weight = F.col(f"strength_{k}")
        return (F.col(k) + F.col(f"mean_{k}") * weight) / (n + weight)

    # The prior is one row.
    return counts.crossJoin(F.broadcast(prior)).select(
        "__llm_host", "__llm_n", *[shrunk(k).alias(f"rate_{k}") for k in rules]
    )


def failed_hosts(judged: DataFrame, host: str, reject_at: float) -> DataFrame:
    """The hosts of which one shrunk rate is above `reject_at`."""
    rules = host_rules()
    rates = host_rates(judged, host, rules)
    worst = F.greatest(*[F.col(f"rate_{k}") for k in rules])
    return rates.where(worst > reject_at).select("__llm_host")


def _base_failed() -> Column:
    few, repeated = base_rules().values()
    return few | repeated


def judge(
    documents: DataFrame,
    scratch: Scratch,
    host: str = "source",
    reject_at: float = 0.5,
) -> DataFrame:
    """(doc_id, __llm_<measure>..., __llm_base_failed, __llm_host_failed, __llm_kept) per row.

    A row is kept if it fails no base rule and its host has not failed. Hosts are
    the values of the column `host`; `doc_id` is passed on and never read.

    A null text has no words and fails, as an empty one does. A row whose host is
    null belongs to no host and is judged by its text alone. Repeated rows each
    count and each get their verdict. Texts are measured whole, one row at a time,
    so a very long text costs memory for its own words. Columns of other names are
    ignored; an empty table gives no rows.
    """
    texts = documents.select("doc_id", "text", F.col(f"`{host}`").alias("__llm_of"))
    rows = scratch.write(measured(texts, ["doc_id", "__llm_of"]), "measured")
    failed = scratch.write(failed_hosts(rows, "__llm_of", reject_at), "failed_hosts")
    host_failed = F.col("__llm_host").isNotNull()
    return rows.join(failed, F.col("__llm_of") == F.col("__llm_host"), "left").select(
        "doc_id",
        *[_name(name) for name in MEASURES],
        _base_failed().alias("__llm_base_failed"),
        host_failed.alias("__llm_host_failed"),
        (~_base_failed() & ~host_failed).alias("__llm_kept"),
    )


def drop_low_quality(
    documents: DataFrame,
    scratch: Scratch,
    host: str = "source",
    reject_at: float = 0.5,
) -> DataFrame:
    """The rows of `documents` that `judge` keeps, with their columns.

    Texts are measured twice, once to judge the hosts and once where the rows are,
    and are not moved unless the list of failed hosts is too large to broadcast.
    """
    sizes = measured(documents, [host])
    failed = scratch.write(failed_hosts(sizes, host, reject_at), "failed_hosts")
    names = [f"`{name}`" for name in documents.columns]
    sound = measured(documents, documents.columns).where(~_base_failed()).select(*names)
    return sound.join(failed, F.col(f"`{host}`") == F.col("__llm_host"), "left_anti")
