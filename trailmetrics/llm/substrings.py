"""Remove passages that an earlier document holds too.

A window is `window` consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller doc_id.

Each window contains an anchor: its run of `anchor` words with the least hash,
the leftmost of equals. Equal windows have equal anchors, so a window can only
be repeated if its anchor recurs in another document. That leaves few runs to
count (about one word in twenty starts an anchor), and few places to compare.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.words import WordHashes, per_row, runs, signed
from trailmetrics.runtime import Scratch

_LARGEST = np.iinfo(np.uint64).max


def _anchor_starts(run_hashes: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window, the place of its anchor among all runs of words."""
    span = window - anchor + 1
    count = len(run_hashes) - span + 1
    # Minima over spans that double, with the leftmost place of equals.
    least, place, width = run_hashes, np.arange(len(run_hashes)), 1
    while width < span:
        step = min(width, span - width)
        right, left = least[step:], least[: len(least) - step]
        take = right < left
        least = np.where(take, right, left)
        place = np.where(take, place[step:], place[: len(place) - step])
        width += step
    return place[:count]


def _window_hashes(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window."""
    return runs(hashes, window), runs(hashes ^ np.uint64(0x5851F42D4C957F2D), window)


def _scan_row(window: int, anchor: int):
    hashes = WordHashes()

    def row(doc_id, text_key, text):
        words = (text or b"").split()
        whole = b" ".join(words)
        digest = hashlib.sha256(whole).hexdigest()
        anchors: np.ndarray | list = []
        if len(words) >= window:
            run_hashes = runs(hashes.of(words), anchor)
            anchors = signed(np.unique(run_hashes[np.unique(_anchor_starts(run_hashes, window, anchor))]))
        return doc_id, text_key, len(words), digest, anchors

    return row


_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n_words", pa.int64()),
        ("sha256", pa.string()),
        ("anchors", pa.list_(pa.int64())),
    ]
)


def _scan(window: int, anchor: int):
    return lambda batches: per_row(_SCANNED, _scan_row(window, anchor))(batches)


_LOCATED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("h1", pa.list_(pa.int64())),
        ("h2", pa.list_(pa.int64())),
    ]
)
_LOCATED_TYPES = (
    "doc_id long, text_key long, starts array<int>, h1 array<long>, h2 array<long>"
)


def _latin(value: bytes) -> str:
    """Bytes as text of one character each, which the automaton can read."""
    return value.decode("latin-1")


def _automaton(phrases: set[bytes]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        automaton.add_word(f" {_latin(phrase)} ")
    automaton.make_automaton()
    return automaton


def _occurrences(automaton: ahocorasick.Automaton, words: list[bytes]) -> np.ndarray:
    """For each word, whether a phrase begins there."""
    located = np.zeros(len(words), bool)
    # A phrase begins with the space before its first word.
    ends = automaton.iter(f" {_latin(b' '.join(words))} ")
    at = [end - length + 1 for end, length in ends]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    spaces = np.cumsum(np.concatenate([[0], lengths[:-1] + 1]))
    located[np.searchsorted(spaces, at)] = True
    return located


def _locate(window: int, anchor: int):
    """Compile a shard's phrases, stream its documents, and compare the windows found.

    A window that starts in a smaller document of the same place is settled here;
    only where a shard has several places, one of each set of equal windows goes
    on, with its hashes.
    """

    def group(table: pa.Table) -> pa.Table:
        names = ("doc_id", "text_key", "text", "anchors")
        ids, keys, texts, anchors = (table[name].to_pylist() for name in names)
        several = table["places"][0].as_py() > 1
        hashes, phrases = WordHashes(), set()
        for text, wanted in zip(texts, anchors):
            words = text.split()
            at = np.flatnonzero(np.isin(signed(runs(hashes.of(words), anchor)), wanted))
            phrases |= {b" ".join(words[i : i + anchor]) for i in at}
        automaton = _automaton(phrases)
        found: list[list[np.ndarray]] = [[], [], [], []]
        for number, text in enumerate(texts):
            words = text.split()
            word_hashes = hashes.of(words)
            places = _anchor_starts(runs(word_hashes, anchor), window, anchor)
            starts = np.flatnonzero(_occurrences(automaton, words)[places])
            h1, h2 = _window_hashes(word_hashes, window)
            rows = np.full(len(starts), number)
            for column, values in zip(found, (h1[starts], h2[starts], rows, starts)):
                column.append(values)
        h1, h2, rows, starts = map(np.concatenate, found)
        docs = np.array(ids)[rows]
        order = np.lexsort((docs, h2, h1))
        h1, h2, rows, starts, docs = (x[order] for x in (h1, h2, rows, starts, docs))
        fresh = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])[: len(h1)]
        first = docs[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(docs) else docs
        settled = docs > first
        out: list[tuple] = []
        for mask, with_hashes in ((settled, False), (~settled & several, True)):
            chosen = np.flatnonzero(mask)
            chosen = chosen[np.argsort(rows[chosen], kind="stable")]
            for part in np.split(chosen, np.flatnonzero(np.diff(rows[chosen])) + 1):
                if len(part):
                    number = rows[part[0]]
                    both = (signed(h1[part]), signed(h2[part])) if with_hashes else (None, None)
                    out.append((ids[number], keys[number], starts[part], *both))
        columns = zip(*out) if out else [[]] * len(_LOCATED)
        arrays = [pa.array(list(c), field.type) for c, field in zip(columns, _LOCATED)]
        return pa.table(arrays, schema=_LOCATED)

    return group


def repeated_windows(
    documents: DataFrame,
    standing: DataFrame,
    scratch: Scratch,
    window: int,
    anchor: int,
    shard_phrases: int,
    shard_words: int,
) -> tuple[DataFrame, DataFrame]:
    """Texts that hold recurring anchors, and their windows that a smaller doc_id starts too.

    Returns (doc_id, text_key, text) and (doc_id, text_key, starts). `standing`
    has the anchors of the documents to compare.
    """
    row = ["doc_id", "text_key"]
    placed = standing.select(*row, "n_words", F.explode("anchors").alias("anchor"))
    recurring = scratch.write(
        placed.groupBy("anchor")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("anchor", "first"),
        "recurring",
    )
    # Anchors that the same document holds first share a shard, so a document that
    # repeats one other document visits few shards.
    shards = max(1, -(-recurring.count() // shard_phrases))
    visits = scratch.write(
        placed.join(recurring, "anchor")
        .groupBy(*row, F.pmod(F.xxhash64("first"), F.lit(shards)).alias("shard"))
        .agg(F.first("n_words").alias("n_words"), F.collect_list("anchor").alias("anchors")),
        "visits",
    )
    # Both sides grow with the corpus: a merge at every size. The texts are kept
    # in buckets of a row's key, so that later joins move only what they add.
    wanted = visits.select(*row).distinct()
    texts = scratch.write(
        documents.join(wanted.hint("merge"), row, "left_semi"), "repeating_texts", buckets=row
    )
    # A shard that many documents visit is compiled in several places.
    loads = visits.groupBy("shard").agg(F.ceil(F.sum("n_words") / shard_words).alias("places"))
    routes = visits.join(loads, "shard").select(
        *row,
        "shard",
        "places",
        F.pmod(F.xxhash64("doc_id"), F.col("places")).alias("place"),
        "anchors",
    )
    located = scratch.write(
        texts.join(routes.hint("merge"), row)
        .groupBy("shard", "place")
        .applyInArrow(_locate(window, anchor), _LOCATED_TYPES),
        "located",
    )
    settled = located.where("h1 IS NULL").select(*row, F.explode("starts").alias("start"))
    open_windows = located.where("h1 IS NOT NULL").select(
        *row, F.inline(F.arrays_zip("starts", "h1", "h2")).alias("start", "h1", "h2")
    )
    first = (
        open_windows.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("h1", "h2", "first")
    )
    across = open_windows.join(first, ["h1", "h2"]).where("doc_id > first").select(*row, "start")
    starts = (
        settled.unionAll(across).groupBy(*row).agg(F.collect_set("start").alias("starts"))
    )
    return texts, starts


_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
    ]
)


def _cut_row(window: int):
    def row(doc_id, text_key, text, starts):
        words = text.split()
        # +1 where a window begins and -1 behind its end; a word stays at sum 0.
        edges = np.zeros(len(words) + 1, np.int64)
        starts = np.asarray(starts, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + window, -1)
        covered = np.cumsum(edges[:-1]) > 0
        kept = [words[i] for i in np.flatnonzero(~covered)]
        return doc_id, text_key, int(covered.sum()), b" ".join(kept)

    return row


def _cut(window: int):
    return lambda batches: per_row(_KEPT, _cut_row(window))(batches)


def dedup_passages(
    documents: DataFrame,
    scratch: Scratch,
    window: int = 50,
    anchor: int = 8,
    shard_phrases: int = 5_000,
    shard_words: int = 2_000_000,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) for each row of `documents`.

    `kept` holds the words that stay, joined by one space, where words were
    removed; it is null where none were. `kept_sha256` covers both.

    1. Documents with the same words form a class. All but the smallest doc_id
       lose everything, if they have a window at all, and are not read again.
    2. Anchors that recur in another document are confirmed by counting.
    3. Their phrases are compiled into automata of about `shard_phrases` phrases;
       each document streams through the shards that hold its anchors. A shard
       with much more than `shard_words` words of visitors is compiled in
       several places.
    4. The windows around the located phrases are compared by 128 bits of hash,
       within a place first and then between the places of a shard; what starts
       in a smaller doc_id too is cut out.

    Null or empty texts have no words. Rows that share a doc_id never remove
    words of each other, and each loses what smaller documents repeat. A row
    with a null doc_id neither removes nor loses words. A very long text is read
    whole, one row at a time, with some 24 bytes a word in its task. Other columns
    are ignored; an empty table gives no rows.
    """
    read = documents.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )
    scanned = scratch.write(
        read.mapInArrow(
            _scan(window, anchor),
            "doc_id long, text_key long, n_words long, sha256 string, anchors array<long>",
        ),
        "scanned",
    )
    usable = scanned.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    classes = scratch.write(
        usable.groupBy("sha256").agg(F.min("doc_id").alias("first_same")), "same_words"
    )
    standing = usable.join(
        classes.withColumnRenamed("first_same", "doc_id"), ["sha256", "doc_id"], "left_semi"
    )
    texts, starts = repeated_windows(
        read.where("doc_id IS NOT NULL"), standing, scratch, window, anchor, shard_phrases, shard_words
    )
    row = ["doc_id", "text_key"]
    cut = scratch.write(
        texts.join(starts.hint("merge"), row)
        .select(*row, "text", "starts")
        .mapInArrow(_cut(window), "doc_id long, text_key long, n_removed long, kept binary")
        .dropDuplicates(row),
        "cut_texts",
    )
    n_words, usable_row = F.col("n_words"), (F.col("n_words") >= window) & F.col("doc_id").isNotNull()
    copy = usable_row & (F.col("doc_id") > F.col("first_same"))
    kept = F.when(copy, F.lit("")).otherwise(F.col("kept").cast("string"))
    return (
        scanned.drop("anchors")
        .join(classes, "sha256", "left")
        .join(cut, row, "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, n_words).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            kept.alias("kept"),
            F.coalesce(F.sha2(kept, 256), "sha256").alias("kept_sha256"),
        )
    )
