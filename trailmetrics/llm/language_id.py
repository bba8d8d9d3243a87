"""Language of a text by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability in a language is the sum over all ways to cut it into pieces,
which the forward algorithm computes; a text's is the product over its words.
Characters that no piece covers are spelled by byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.llm.words import mix
from trailmetrics.runtime import Scratch

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
_LETTERS = re.compile(r"[^\W\d_]+")
# What the vocabulary puts before the first piece of a word.
_WORD_START = "▁"
# Words of the sample that are longer teach in parts of this many characters. Words
# that are judged are summed over as a whole; those longer go one at a time.
_PART = 64
# Characters of a long word that are looked up at once.
_STRETCH = 4096
_SALTS = 64


def load_pieces(path: str) -> dict[str, int]:
    """Piece by id; the 256 byte pieces come as `<0x00>` to `<0xFF>`."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): i for i in range(model.get_piece_size())}


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall(text.lower()) if text else []


def spelled(word: str) -> str | None:
    """A word as the vocabulary spells it; numerals without a letter have no spelling."""
    return _WORD_START + word if any(map(str.isalpha, word)) else None


def parts_of(word: str) -> list[str]:
    """A word's spelling in parts, to learn from."""
    marked = spelled(word) or ""
    return [marked[start : start + _PART] for start in range(0, len(marked), _PART)]


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary as a hash table that finds many pieces at once.

    A piece is known by 64 bits of hash of its characters.
    """

    def __init__(self, pieces: dict[str, int]) -> None:
        self.count = len(pieces)
        self.bytes = [pieces[f"<0x{byte:02X}>"] for byte in range(256)]
        self.longest = max(map(len, pieces))
        bits = max(4, self.count.bit_length() + 3)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.ids = np.full(1 << bits, -1, np.int64)
        self.probes = 1
        for piece, number in pieces.items():
            key = np.zeros(1, np.uint64)
            for char in piece:
                key = key * _BASE + np.uint64(ord(char) + 1)
            key = mix(key)
            at, probe = int(key[0] >> self.shift), 0
            while self.ids[(at + probe) & self.mask] >= 0:
                probe += 1
            self.keys[(at + probe) & self.mask] = key[0]
            self.ids[(at + probe) & self.mask] = number
            self.probes = max(self.probes, probe + 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 where there is none."""
        keys = mix(hashes)
        at = (keys >> self.shift).astype(np.int64)
        found = np.full(len(keys), -1)
        for probe in range(self.probes):
            here = (at + probe) & self.mask
            found = np.where(self.keys[here] == keys, self.ids[here], found)
        return found


class Lattice:
    """All pieces of words of one length, as arcs from one character to another."""

    def __init__(self, words: list[str], pieces: Pieces) -> None:
        self.length, self.count = len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        known, grid = np.unique(codes, return_inverse=True)
        self.grid = grid.reshape(self.count, self.length)
        by_place = (codes.reshape(self.count, self.length).T + 1).astype(np.uint64)
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for start in range(self.length):
            hashes = np.zeros(self.count, np.uint64)
            for end in range(start + 1, min(self.length, start + pieces.longest) + 1):
                hashes = hashes * _BASE + by_place[end - 1]
                ids = pieces.find(hashes)
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    self.arcs.append((start, end, rows, ids[rows]))
        self.arcs.sort(key=lambda arc: arc[1])
        # Each character can also be spelled by its bytes.
        self.bytes = [[pieces.bytes[byte] for byte in chr(code).encode()] for code in known]

    def spelled(self, log_p: np.ndarray) -> np.ndarray:
        """Log probability of each known character, spelled by bytes."""
        return np.array([log_p[ids].sum(axis=0) for ids in self.bytes])

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log of the summed probability up to each character; [position, word, language]."""
        total = np.full((self.length + 1, self.count, log_p.shape[1]), -np.inf)
        total[0] = 0
        spelled = self.spelled(log_p)
        arcs = iter(self.arcs)
        arc = next(arcs, None)
        for end in range(1, self.length + 1):
            total[end] = total[end - 1] + spelled[self.grid[:, end - 1]]
            while arc is not None and arc[1] == end:
                start, _, rows, ids = arc
                total[end, rows] = np.logaddexp(total[end, rows], total[start, rows] + log_p[ids])
                arc = next(arcs, None)
        return total

    def expected(self, log_p: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Add the expected uses of each piece to `into`, weighted by the words' counts."""
        before = self.forward(log_p)
        spelled = self.spelled(log_p)
        after = np.full_like(before, -np.inf)
        after[self.length] = 0
        for end in range(self.length, 0, -1):
            at = end - 1
            after[at] = np.logaddexp(after[at], after[end] + spelled[self.grid[:, at]])
            for start, _, rows, ids in (arc for arc in self.arcs if arc[1] == end):
                after[start, rows] = np.logaddexp(after[start, rows], after[end, rows] + log_p[ids])
        whole = before[self.length]
        for start, end, rows, ids in self.arcs:
            use = np.exp(before[start, rows] + log_p[ids] + after[end, rows] - whole[rows])
            np.add.at(into, ids, use * counts[rows])
        uses = np.zeros_like(spelled)
        for at in range(self.length):
            chars = self.grid[:, at]
            use = np.exp(before[at] + spelled[chars] + after[at + 1] - whole)
            np.add.at(uses, chars, use * counts)
        for ids, use in zip(self.bytes, uses):
            np.add.at(into, ids, use)


def _log_sum(terms: np.ndarray) -> np.ndarray:
    most = terms.max(axis=0)
    return most + np.log(np.exp(terms - most).sum(axis=0))


def long_word(word: str, pieces: Pieces, log_p: np.ndarray) -> np.ndarray:
    """Log of a word's probability, summed over all segmentations, however long it is.

    Pieces are looked up for a stretch of characters at a time, and only the sums of
    the last characters that a piece can start from are kept.
    """
    longest = pieces.longest
    # Row i is the sum up to the character i places before the next one.
    last = np.full((longest, log_p.shape[1]), -np.inf)
    last[0] = 0
    by_byte: dict[str, np.ndarray] = {}
    for start in range(0, len(word), _STRETCH):
        text = word[max(0, start - longest + 1) : start + _STRETCH]
        before = min(start, longest - 1)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        hashes = np.zeros(len(codes), np.uint64)
        found = np.full((longest, len(codes)), -1)
        for size in range(1, min(longest, len(codes)) + 1):
            # Of the pieces of this size, by where they start.
            hashes = hashes[: len(codes) - size + 1] * _BASE + codes[size - 1 :]
            found[size - 1, size - 1 :] = pieces.find(hashes)
        for at in range(before, len(text)):
            char = text[at]
            if char not in by_byte:
                by_byte[char] = log_p[[pieces.bytes[b] for b in char.encode()]].sum(axis=0)
            sizes = np.flatnonzero(found[:, at] >= 0)
            terms = last[sizes] + log_p[found[sizes, at]]
            total = _log_sum(np.concatenate([[last[0] + by_byte[char]], terms]))
            last = np.concatenate([[total], last[:-1]])
    return last[0]


def _by_length(words: Iterable[str], most: int = 20_000) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    for group in groups.values():
        for start in range(0, len(group), most):
            yield group[start : start + most]


def _expected_counts(pieces, log_p, languages):
    """Expected piece counts of (lang, word, n) rows; one row per piece and language."""

    def run(batches):
        known = Pieces(pieces.value)
        into = np.zeros_like(log_p.value)
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            for lang, word, n in zip(*(column.to_pylist() for column in batch.columns)):
                counts.setdefault(word, np.zeros(len(languages)))[languages.index(lang)] += n
            for words in _by_length(counts):
                rows = np.array([counts[word] for word in words])
                Lattice(words, known).expected(log_p.value, rows, into)
        ids, columns = np.nonzero(into)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(columns, pa.int32()), pa.array(into[ids, columns])],
            names=["piece", "language", "n"],
        )

    return run


class PieceModel:
    """Log probabilities of the pieces, one column per language."""

    def __init__(self, languages: list[str], pieces: dict[str, int], log_p: np.ndarray) -> None:
        self.languages, self.pieces, self.log_p = languages, pieces, log_p


def fit(
    labelled: DataFrame,
    scratch: Scratch,
    vocabulary: str = VOCABULARY,
    sample: int = 500,
    rounds: int = 3,
    smoothing: float = 0.1,
) -> PieceModel:
    """Learn piece probabilities by expectation maximisation.

    `labelled` has doc_id, text and lang. Each language learns from at most
    `sample` documents, those with the least hash of doc_id; rows without a
    language or a text teach nothing, and rows that repeat a document teach with
    it. Without any labelled text no language is learned. Word counts and expected
    piece counts are summed by Spark; what reaches the driver is one number per
    piece and language.
    """
    spark = labelled.sparkSession
    # Cut in `_SALTS` parts of a language first, so that the last cut sees that many
    # times `sample` rows at most, however many tasks and documents there are.
    salt = F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(_SALTS))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("rank", rank).where(F.col("rank") <= sample)

    candidates = (
        labelled.where("lang IS NOT NULL AND text IS NOT NULL")
        .select("doc_id", "lang")
        .withColumn("salt", salt)
    )
    chosen = scratch.write(
        first(first(candidates, "lang", "salt"), "lang")
        .select("doc_id", "lang")
        .distinct(),
        "language_sample",
    )
    texts = labelled.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])

    def split(batches):
        for batch in batches:
            langs, words = [], []
            for lang, text in zip(*(column.to_pylist() for column in batch.columns)):
                found = [part for word in words_of(text) for part in parts_of(word)]
                words += found
                langs += [lang] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string())], names=["lang", "word"]
            )

    counts = scratch.write(
        texts.select("lang", "text")
        .mapInArrow(split, "lang string, word string")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n")),
        "language_words",
    )
    languages = sorted(row[0] for row in counts.select("lang").distinct().collect())
    pieces = load_pieces(vocabulary)
    log_p = np.full((len(pieces), len(languages)), -np.log(len(pieces)))
    known = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds if languages else 0):
        now = spark.sparkContext.broadcast(log_p)
        sums = (
            counts.mapInArrow(
                _expected_counts(known, now, languages), "piece int, language int, n double"
            )
            .groupBy("piece", "language")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        expected = np.zeros_like(log_p)
        expected[sums["piece"].to_numpy(), sums["language"].to_numpy()] = sums["n"].to_numpy()
        now.unpersist()
        log_p = np.log(expected + smoothing) - np.log(
            expected.sum(axis=0) + smoothing * len(pieces)
        )
    known.unpersist()
    return PieceModel(languages, pieces, log_p)


class _Words(dict):
    """The row of each word in a table of log probabilities, filled when asked.

    Row 0 is for words without a letter.
    """

    LIMIT = 400_000

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.pieces = Pieces(model.pieces)
        self.table = np.zeros((1, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self) + len(words) > self.LIMIT:
            self.clear()
            self.table = self.table[:1]
        new = {word: spelled(word) for word in words.difference(self)}
        log_p = {}
        short = {marked for marked in new.values() if marked and len(marked) <= _PART}
        for group in _by_length(short):
            lattice = Lattice(group, self.pieces)
            log_p.update(zip(group, lattice.forward(self.model.log_p)[-1]))
        rows = []
        for word, marked in new.items():
            self[word] = len(self.table) + len(rows) if marked else 0
            if not marked:
                continue
            if marked not in log_p:
                log_p[marked] = long_word(marked, self.pieces, self.model.log_p)
            rows.append(log_p[marked])
        if rows:
            self.table = np.concatenate([self.table, rows])


_JUDGED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _judge(model):
    def run(batches):
        known = _Words(PieceModel(*model.value))
        languages = known.model.languages
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [words_of(text) for text in part.column("text").to_pylist()]
                known.learn({word for words in texts for word in words})
                langs, scores = [], []
                for words in texts:
                    rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    if not rows.any() or not languages:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    total = known.table[rows].sum(axis=0)
                    best = int(total.argmax())
                    langs.append(languages[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    schema=_JUDGED,
                )

    return run


def predict(documents: DataFrame, model: PieceModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `documents`, from its text alone.

    `score` is the probability of the predicted language among the learned ones,
    all equally likely beforehand; of equal ones the first by name wins. A null
    text, or one without a letter, is `und` with score 0, as is every text if no
    language was learned. Texts and words of any length are summed over whole; a
    word of more than 64 characters takes time by its length. Other columns are
    ignored; an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.log_p))
    ids = documents.select(F.col("doc_id").cast("long"), "text")
    return ids.mapInArrow(
        _judge(sent), "doc_id long, lang_pred string, score double"
    )
