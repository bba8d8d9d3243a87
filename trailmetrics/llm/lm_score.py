"""Score documents by the difference of two language models' losses.

A target and a background bigram model share one vocabulary, order and smoothing.
A document's score is its loss per word under the target model minus that under
the background model: low scores are near the target. A target document is judged
by the other targets: its own counts are left out of the target model, as those of
all other documents are, so a score does not tell whether a document was a target.
The background holds every document, the judged one too.

A loss is a sum over terms: one for each pair of words, one for each history. A
text's pairs meet all other uses of their last word in one task, which counts the
word, its pairs and the histories that it is, and adds up what each text loses. Words
and pairs so frequent that a task would have too many of them are counted
beforehand, and broadcast. One range of hashes is done after another, so only a share
of the pairs lies on disk at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.llm.words import WordHashes, mix, signed
from trailmetrics.runtime import Scratch

_OTHER, _START = np.uint64(0), np.uint64(1)
# Fixed values that keep the names of pairs, and those of pairs in a text, apart.
_TEXT, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# Classes of frequency for each doubling of a count.
_CLASSES = 64
# Values of a packed array at most.
_ROWS = 100_000
_WORDS_ONLY = ["name", "is_target", "n_words", "words"]
# Spark's setting by which a query's shuffle files are deleted when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Words:
    """Words as 64-bit hashes; those outside a given vocabulary share one value."""

    def __init__(self, known) -> None:
        self.hashes, self.known = WordHashes(), known and known.value

    def of(self, text: bytes | None) -> np.ndarray:
        words = self.hashes.of((text or b"").lower().split())
        if self.known is None:
            return words
        return np.where(np.isin(words, self.known), words, _OTHER)


def _word_counts(most: int):
    """(word, n) of a task's documents; the counts go out whenever there are many."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())],
            names=["word", "n"],
        )

    def run(batches):
        counts: Counter = Counter()
        words = Words(None)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(signed(words.of(text)).tolist())
                if len(counts) >= most:
                    yield out(counts)
                    counts.clear()
        yield out(counts)

    return run


_WORDED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("name", pa.int64()),
        ("is_target", pa.bool_()),
        ("n_words", pa.int64()),
        ("words", pa.list_(pa.int64())),
        ("uses", pa.list_(pa.int32())),
    ]
)


def _worded(known):
    """Each text as the hashes of its words, with the number of uses of each in the text.

    Where a word stands first in the text, that number is below 0.
    """

    def run(batches):
        words = Words(known)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                targets = [bool(t) for t in part.column("is_target").to_pylist()]
                found, uses = [], []
                for text in part.column("text").to_pylist():
                    own = words.of(text)
                    _, first, which, counts = np.unique(
                        own, return_index=True, return_inverse=True, return_counts=True
                    )
                    found.append(own)
                    uses.append(counts[which].astype(np.int32))
                    uses[-1][first] *= -1
                sizes = [len(own) for own in found]
                ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
                lists = [signed(np.concatenate(found)), np.concatenate(uses)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("name"),
                        pa.array(targets),
                        pa.array(sizes, pa.int64()),
                        *(pa.ListArray.from_arrays(ends, pa.array(values)) for values in lists),
                    ],
                    schema=_WORDED,
                )

    return run


class _Texts:
    """Some texts, one after another.

    `own` is the size of a target, and 0 elsewhere. Where a word stands first in a
    text, `history` says how many words follow uses of it; elsewhere it is 0.
    """

    def __init__(self, columns: dict[str, np.ndarray]) -> None:
        self.names, self.sizes = columns["name"], columns["n_words"]
        self.own = (self.sizes * columns["is_target"]).astype(np.int32)
        self.words = columns["words"].view(np.uint64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        ends = np.cumsum(self.sizes)
        self.starts = (ends - self.sizes)[self.sizes > 0]
        self.lasts = (ends - 1)[self.sizes > 0]
        if "uses" in columns:
            self.uses = np.abs(columns["uses"])
            first = np.flatnonzero(columns["uses"] < 0)
            is_last = self.words[first] == self.words[ends[self.owner[first]] - 1]
            self.history = np.zeros_like(self.uses)
            self.history[first] = self.uses[first] - is_last

    def pairs(self) -> np.ndarray:
        """The name of each word's pair with the word before it."""
        before = np.roll(self.words, 1)
        before[self.starts] = _START
        return _pair(before, self.words)

    def used(self, pairs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs at some words: a place of each text's pair, its uses and its history."""
        order, starts = _grouped(mix(pairs + self.owner[at].astype(np.uint64) * _TEXT))
        uses = np.diff(np.concatenate([starts, [len(order)]]))
        history = _sums(self.history[at], order, starts)
        return at[order[starts]], uses.astype(np.int32), history.astype(np.int32)


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before ^ _PAIR) + word)


def _texts(batches: Iterable[pa.RecordBatch], at_once: int) -> Iterator[_Texts]:
    """The texts of a task, about `at_once` words at a time."""
    held: list[dict[str, np.ndarray]] = []

    def together() -> _Texts:
        return _Texts({key: np.concatenate([part[key] for part in held]) for key in held[0]})

    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            columns = {
                field.name: column.flatten().to_numpy()
                if pa.types.is_list(field.type)
                else column.to_numpy(zero_copy_only=False)
                for field, column in zip(part.schema, part.columns)
            }
            held.append(columns)
            if sum(len(columns["words"]) for columns in held) >= at_once:
                yield together()
                held = []
    if held:
        yield together()


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys are neighbours, and where each key begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]])
    return order, np.flatnonzero(new)


def _sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of the values of each key."""
    return np.add.reduceat(values[order], starts) if len(starts) else values[:0]


def _totals(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """For each row the sums of the values of all rows of its key."""
    order, starts = _grouped(keys)
    sizes = np.diff(np.concatenate([starts, [len(order)]]))
    back = np.empty(len(order), np.int64)
    back[order] = np.repeat(np.arange(len(starts)), sizes)
    return [_sums(v.astype(np.int64), order, starts)[back] for v in values]


def _found(values: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value in a sorted array, and whether it is there."""
    if not len(held):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(held, values), len(held) - 1)
    return at, held[at] == values


# What the arrays hold that travel as bytes.
_BYTES = {
    "key": "<u8", "n": "<i8", "in_target": "<i8",
    "word": "<u8", "pair": "<u8", "name": "<i8",
    "uses": "<i4", "word_uses": "<i4", "history": "<i4", "own": "<i4",
    "target": "<f8", "background": "<f8",
}
_COUNTS = ["key", "n", "in_target"]
_PAIRS = ["word", "pair", "name", "uses", "word_uses", "history", "own"]
_LOSSES = ["name", "target", "background"]


def _types(names: list[str]) -> str:
    return "part int, " + ", ".join(f"{name} binary" for name in names)


def _packed(part: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows of a number of a part and arrays of what belongs to it, as bytes."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
    starts = np.union1d(starts, np.arange(0, len(part), _ROWS))
    ends = [*starts[1:], len(part)]
    arrays = [pa.array(part[starts], pa.int32())]
    for name, column in zip(names, columns):
        values = column[order].astype(_BYTES[name], copy=False)
        arrays.append(
            pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())
        )
    return pa.RecordBatch.from_arrays(arrays, names=["part", *names])


def _unpacked(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table[name].to_pylist()), _BYTES[name]) for name in names]


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys ^ _TEXT) % np.uint64(parts)).astype(np.int64)


def _counted(keys: np.ndarray, is_target: np.ndarray, parts: int) -> pa.RecordBatch:
    """The rows with each key, and those in targets, packed."""
    order, starts = _grouped(keys)
    key = keys[order[starts]]
    n = np.diff(np.concatenate([starts, [len(order)]]))
    in_target = _sums(is_target.astype(np.int64), order, starts)
    return _packed(_part(key, parts), [key, n, in_target], _COUNTS)


def _counted_words(parts: int, at_once: int):
    def run(batches):
        for texts in _texts(batches, at_once):
            yield _counted(texts.words, texts.own[texts.owner] > 0, parts)

    return run


def _counted_frequent(frequent, parts: int, at_once: int):
    """Counts of pairs of frequent words (or of a start and one), and of words that end texts.

    A pair's key is made of the places of its words, the second one the remainder;
    above all pairs are the words at the ends.
    """

    def run(batches):
        held = frequent.value
        above = (len(held) + 1) * len(held)
        for texts in _texts(batches, at_once):
            at, known = _found(texts.words, held)
            before, follows = np.roll(at, 1), np.roll(known, 1)
            before[texts.starts], follows[texts.starts] = len(held), True
            in_pairs = np.flatnonzero(known & follows)
            ends = texts.lasts[known[texts.lasts]]
            keys = np.concatenate([before[in_pairs] * len(held) + at[in_pairs], above + at[ends]])
            is_target = texts.own[texts.owner[np.concatenate([in_pairs, ends])]] > 0
            yield _counted(keys.astype(np.uint64), is_target, parts)

    return run


def _summed(least: int, above: int):
    """The number of keys of a part; those used `least` times, or from `above` on, with counts."""

    def run(table: pa.Table) -> pa.Table:
        key, n, in_target = _unpacked(table, _COUNTS)
        order, starts = _grouped(key)
        key, n, in_target = key[order[starts]], _sums(n, order, starts), _sums(in_target, order, starts)
        # Only keys of pairs have others above them.
        kept = (n >= least) | ((key >= above) if above else False)
        packed = (pa.array([values[kept].tobytes()], pa.binary()) for values in (key, n, in_target))
        return pa.table([pa.array([len(key)], pa.int64()), *packed], names=["size", *_COUNTS])

    return run


def _collected(counted: DataFrame, least: int, above: int = 0) -> tuple[int, list[np.ndarray]]:
    """The number of keys; the frequent ones with their counts, in the order of keys."""
    types = _types(_COUNTS).replace("part int", "size long")
    found = counted.groupBy("part").applyInArrow(_summed(least, above), types).toArrow()
    columns = _unpacked(found, _COUNTS)
    order = np.argsort(columns[0])
    return sum(found["size"].to_pylist()), [column[order] for column in columns]


class _Frequent:
    """Frequent words and pairs with their counts, and how often a word is a history."""

    def __init__(self, worded: DataFrame, words: list[np.ndarray], least: int, parts: int, at_once: int):
        self.words = words[0]
        self.word_n, self.word_in_target = words[1:]
        size = len(self.words)
        above = (size + 1) * size
        self.history_n, self.history_in_target = self.word_n.copy(), self.word_in_target.copy()
        pairs = [np.zeros(0, np.int64)] * 3
        if size:
            sent = worded.sparkSession.sparkContext.broadcast(self.words)
            counted = worded.select(*_WORDS_ONLY).mapInArrow(
                _counted_frequent(sent, parts, at_once), _types(_COUNTS)
            )
            _, (key, n, in_target) = _collected(counted, least, above)
            key = key.astype(np.int64)
            sent.destroy()
            ends = key >= above
            self.history_n[key[ends] - above] -= n[ends]
            self.history_in_target[key[ends] - above] -= in_target[ends]
            pairs = [key[~ends], n[~ends], in_target[~ends]]
        before = np.append(self.words, _START)[pairs[0] // max(1, size)]
        names = _pair(before, self.words[pairs[0] % max(1, size)])
        order = np.argsort(names)
        self.pairs, self.pair_n, self.pair_in_target = names[order], pairs[1][order], pairs[2][order]


class _Model:
    """Counts of all words and texts, in all and in the target, and the smoothing."""

    def __init__(self, words: int, texts: int, target_words: int, target_texts: int, size: int, weight: float):
        self.words, self.target_words = words, target_words
        self.texts, self.target_texts = texts, target_texts
        self.size, self.weight = max(1, size), weight

    def pair_losses(self, uses, word_uses, own, counts, word_counts) -> list[np.ndarray]:
        """The two losses of a text's pair: without what a target's own uses add to the target.

        Background counts are scaled to the size of the target without the text.
        """
        (n, in_target), (word_n, word_in_target) = counts, word_counts
        left, is_target = self.target_words - own.astype(np.int64), own > 0
        scale = left / max(1, self.words)
        share = self.weight / (left + self.size)
        target = in_target - uses * is_target
        word_target = word_in_target - word_uses * is_target
        return [
            -uses * np.log(target + (word_target + 1) * share),
            -uses * np.log(n * scale + (word_n * scale + 1) * share),
        ]

    def history_losses(self, uses, own, counts) -> list[np.ndarray]:
        """The two losses of a text's history."""
        n, in_target = counts
        scale = (self.target_words - own.astype(np.int64)) / max(1, self.words)
        return [
            uses * np.log(in_target - uses * (own > 0) + self.weight),
            uses * np.log(n * scale + self.weight),
        ]


def _dealt(number: int, slices: int, parts: int, frequent, at_once: int):
    """Each text's pairs of a slice, packed by the parts in which they are counted.

    A part has all pairs of a word, or all uses of a pair where the word is frequent.
    """

    def run(batches):
        held = frequent.value
        for texts in _texts(batches, at_once):
            pairs = texts.pairs()
            by = texts.words.copy()
            common = np.flatnonzero(_found(texts.words, held.words)[1])
            by[common] = pairs[common]
            part = _part(by, slices * parts)
            mine = part % slices == number
            mine[common] &= ~_found(pairs[common], held.pairs)[1]
            at = np.flatnonzero(mine)
            at, uses, history = texts.used(pairs[at], at)
            order = np.argsort(at)
            at, owner = at[order], texts.owner[at[order]]
            columns = [texts.words[at], pairs[at], texts.names[owner]]
            columns += [uses[order], texts.uses[at], history[order], texts.own[owner]]
            yield _packed(part[at] // slices, columns, _PAIRS)

    return run


def _judged(frequent, model: _Model, parts: int):
    """Counts the words, pairs and histories of a part, and sums the losses of each text."""

    def run(table: pa.Table) -> pa.Table:
        held = frequent.value
        word, pair, name, uses, word_uses, history, own = _unpacked(table, _PAIRS)
        is_target = own > 0
        counts = _totals(pair, uses, uses * is_target)
        at, common = _found(word, held.words)
        n, in_target, history_n, history_in_target = _totals(
            word, uses, uses * is_target, history, history * is_target
        )
        n[common] = held.word_n[at[common]]
        in_target[common] = held.word_in_target[at[common]]
        # Histories of frequent words are counted with their texts.
        history = np.where(common, 0, history)
        losses = zip(
            model.pair_losses(uses, word_uses, own, counts, (n, in_target)),
            model.history_losses(history, own, (history_n, history_in_target)),
        )
        order, starts = _grouped(name)
        name = name[order[starts]]
        sums = [_sums(of_pair + of_history, order, starts) for of_pair, of_history in losses]
        return pa.Table.from_batches([_packed(_part(name.view(np.uint64), parts), [name, *sums], _LOSSES)])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sums of the losses of each text of a part."""
    name, *losses = _unpacked(table, _LOSSES)
    order, starts = _grouped(name)
    sums = [_sums(loss, order, starts) for loss in losses]
    return pa.table([name[order[starts]], *sums], names=_LOSSES)


def _common(frequent, model: _Model, at_once: int):
    """A row per text with its losses from frequent pairs and histories, and from its start."""

    def run(batches):
        held = frequent.value
        for texts in _texts(batches, at_once):
            own = np.where(texts.sizes > 0, texts.own, 0)
            started = (texts.sizes > 0).astype(np.int64)
            sums = model.history_losses(started, own, (model.texts, model.target_texts))
            pairs = texts.pairs()
            place, known = _found(texts.words, held.words)
            at = np.flatnonzero(known)
            at = at[_found(pairs[at], held.pairs)[1]]
            at, uses, _ = texts.used(pairs[at], at)
            of_pair, of_word = _found(pairs[at], held.pairs)[0], place[at]
            added = model.pair_losses(
                uses,
                texts.uses[at],
                texts.own[texts.owner[at]],
                (held.pair_n[of_pair], held.pair_in_target[of_pair]),
                (held.word_n[of_word], held.word_in_target[of_word]),
            )
            sums = [s + np.bincount(texts.owner[at], a, len(s)) for s, a in zip(sums, added)]
            at = np.flatnonzero(known & (texts.history > 0))
            added = model.history_losses(
                texts.history[at],
                texts.own[texts.owner[at]],
                (held.history_n[place[at]], held.history_in_target[place[at]]),
            )
            sums = [s + np.bincount(texts.owner[at], a, len(s)) for s, a in zip(sums, added)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, (texts.names, *sums))], names=_LOSSES)

    return run


def _least_class(counts: DataFrame, most: int) -> int:
    """The lowest class of frequency down to which there are at most `most` rows."""
    sizes = counts.groupBy("class").agg(F.count("*").alias("held")).collect()
    total, least = 0, 1 << 20
    for row in sorted(sizes, reverse=True):
        total += row["held"]
        if total > most:
            break
        least = row["class"]
    return least


def _class():
    return F.floor(F.log2("n") * _CLASSES)


def score(
    documents: DataFrame,
    target_ids: DataFrame,
    scratch: Scratch,
    vocabulary: int | None = None,
    weight: float = 200.0,
    words_at_once: int = 1_000_000,
    frequent: int = 4000,
    slices: int = 4,
) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of each row of `documents`.

    The background is all documents, the target those whose doc_id is in
    `target_ids`, without the row that is judged. Every word (A-Z lower-cased) that
    occurs is known to both models, and every pair of words has a count of its own;
    words, pairs and texts are compared by 64 bits of hash. Only
    if `vocabulary` is given, at most so many of the most frequent words are known
    and all others are one word: words fall into classes of about equal counts
    (within 1 %), taken from the top.

    Texts are moved once, to learn which are targets, and written as hashes of
    words. A first pass counts all words, a second one pairs of frequent words: those
    that are at least one in `frequent` of all words, so there are at most so many.
    Frequent words and pairs reach the tasks by broadcast, with their exact counts.
    Every other pair of every text is shuffled once, by its word (by the pair where
    the word is frequent), and its losses once, by the text. Pairs fall into `slices`
    by hash, and Spark deletes the shuffles of one slice before the next one. They
    travel packed into lists, and a task takes about `words_at_once` words at a time.
    These numbers change the cost, not the result.

    Losses are in nats per word. A text without words has no losses and no
    score. Without other target documents, both models are uniform. Repeated rows
    count as often as they occur, and each is judged with the others in the target; a
    null doc_id is never a target. A very long text is taken whole, with 12 bytes
    a word in its task. Other columns are ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    with _shuffles_deleted(spark):
        known = None
        if vocabulary is not None:
            word_counts = scratch.write(
                texts.select("text")
                .mapInArrow(_word_counts(words_at_once), "word long, n long")
                .groupBy("word")
                .agg(F.sum("n").alias("n"))
                .withColumn("class", _class()),
                "word_counts",
            )
            least = _least_class(word_counts, vocabulary)
            chosen = word_counts.where(F.col("class") >= least).collect()
            known = np.array(sorted(row["word"] for row in chosen), np.int64).view(np.uint64)
            known = spark.sparkContext.broadcast(known)
        targets = target_ids.select(
            F.col("doc_id").cast("long"), F.lit(True).alias("is_target")
        ).distinct()
        worded = scratch.write(
            # Both sides grow with the corpus: a merge at every size.
            texts.join(targets.hint("merge"), "doc_id", "left")
            .select("doc_id", F.monotonically_increasing_id().alias("name"), "text", "is_target")
            .mapInArrow(
                _worded(known),
                "doc_id long, name long, is_target boolean, n_words long, words array<long>, "
                "uses array<int>",
            ),
            "worded",
        )
        one, size_of_target = F.when(F.col("n_words") > 0, 1), F.when(F.col("is_target"), F.col("n_words"))
        sums = worded.agg(
            F.sum("n_words"),
            F.sum(one),
            F.sum(size_of_target),
            F.sum(F.when(F.col("is_target"), one)),
        ).first()
        sums = [value or 0 for value in sums]
        total = sums[0]
        parts = 1 + total // words_at_once
        least = max(1, -(-total // frequent)) if frequent else total + 1
        counted = worded.select(*_WORDS_ONLY).mapInArrow(
            _counted_words(parts, words_at_once), _types(_COUNTS)
        )
        size, words = _collected(counted, least)
        model = _Model(*sums, size, float(weight))
        sent = spark.sparkContext.broadcast(_Frequent(worded, words, least, parts, words_at_once))
        used, loss_types = worded.drop("doc_id"), "name long, target double, background double"
        losses = used.mapInArrow(_common(sent, model, words_at_once), loss_types)
        for number in range(slices):
            dealt = used.mapInArrow(
                _dealt(number, slices, 1 + parts // slices, sent, words_at_once), _types(_PAIRS)
            )
            judged = dealt.groupBy("part").applyInArrow(_judged(sent, model, parts), _types(_LOSSES))
            added = judged.groupBy("part").applyInArrow(_added, loss_types)
            losses = losses.unionAll(scratch.write(added, f"losses_{number}"))

        def loss(model: str) -> Column:
            return F.when(F.col("n_words") > 0, F.col(model) / F.col("n_words")).alias(f"{model}_loss")

        judged = (
            worded.select("name", "doc_id", "n_words")
            .unionByName(losses, allowMissingColumns=True)
            .groupBy("name")
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("n_words").alias("n_words"),
                F.sum("target").alias("target"),
                F.sum("background").alias("background"),
            )
            .select("doc_id", "n_words", loss("target"), loss("background"))
            .withColumn("score", F.col("target_loss") - F.col("background_loss"))
        )
        scores = scratch.write(judged, "scores")
        sent.destroy()
    for name in ("worded", "word_counts", *(f"losses_{i}" for i in range(slices))):
        scratch.drop(name)
    return scores
