"""Hashing words and runs of words inside tasks, with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

class WordHashes(dict):
    """The 64-bit hash of each word, kept for the words met so far.

    The words are forgotten when there are many, which bounds the memory and
    changes no hash.
    """

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of a common public hash)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


# Odd multipliers without a pattern among them, so that runs of the same words in
# another order differ.
_MULTIPLIERS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` words; fewer words are one run, none give none."""
    count = len(hashes)
    if count == 0:
        return hashes
    size = min(size, count)
    total = np.full(count - size + 1, size, np.uint64)
    for i in range(size):
        total += hashes[i : count - size + 1 + i] * _MULTIPLIERS[i % 64]
        if i % 64 == 63:
            total = mix(total)
    return mix(total)


def signed(values: np.ndarray) -> np.ndarray:
    """As Spark's long, bit by bit."""
    return values.view(np.int64)


def per_row(
    schema: pa.Schema, row: Callable[..., tuple | None], rows_per_batch: int = 500
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that calls `row` on each input row.

    `row` returns the values of an output row, or None for no row; output goes
    out in small batches, so long rows do not pile up.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows_per_batch):
                part = batch.slice(start, rows_per_batch)
                found = [row(*values) for values in zip(*(c.to_pylist() for c in part.columns))]
                columns = list(zip(*(values for values in found if values is not None)))
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                    )

    return run
