"""Severity of toxic language by cumulative-link ordinal regression.

One weight per text feature is shared by all ordered thresholds: the odds that a
document's grade is at most k are ``exp(threshold[k] - weights . features)``. The
model gives a probability for every grade, and their mean is the severity.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.words import per_row
from trailmetrics.runtime import Scratch

_WORD = re.compile(r"[^\W\d_]+")
# A word counts by itself and by its beginnings of these lengths.
_PREFIXES = (4, 5, 6)
# Features are hashed to this many bits.
_BITS = 18
# Rates are per 100 words, of texts taken as 20 words longer, and at most 3: one
# word of a short text is little proof, and one word repeated no more than another.
_PER, _SHORT, _MOST = 100.0, 20.0, 3.0
# Numbers of a gradient that are added up in one group.
_CHUNK = 8192


class Features(dict):
    """The row of each word in a table of feature numbers, filled when asked."""

    LIMIT = 200_000

    def __init__(self) -> None:
        self.table = np.full((1024, 1 + len(_PREFIXES)), -1, np.int32)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        names = [f"={word}"] + [f"^{word[:n]}" for n in _PREFIXES if len(word) > n]
        numbers = [xxhash.xxh64_intdigest(name) >> (64 - _BITS) for name in names]
        self.table[row, : len(numbers)] = numbers
        self.table[row, len(numbers) :] = -1
        return row

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of a text and their rates."""
        if len(self) > self.LIMIT:
            self.clear()
        words = _WORD.findall((text or "").lower())
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        flat = self.table[rows].ravel()
        numbers, counts = np.unique(flat[flat >= 0], return_counts=True)
        return numbers, np.minimum(counts * (_PER / (len(words) + _SHORT)), _MOST)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free numbers: the first, then logs of the steps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def grade_odds(score: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Probability of each grade; one row per score."""
    upto = _sigmoid(limits[None, :] - score[:, None])
    upto = np.hstack([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))])
    return np.diff(upto, axis=1)


def loss_and_gradient(
    owner: np.ndarray,
    numbers: np.ndarray,
    rates: np.ndarray,
    grades: np.ndarray,
    weights: np.ndarray,
    free: np.ndarray,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed loss, its gradient by weights and by the free threshold numbers.

    `owner` says which row each feature number and rate belongs to.
    """
    limits = thresholds(free)
    score = np.bincount(owner, weights[numbers] * rates, len(grades))
    edges = np.concatenate([[-np.inf], limits, [np.inf]])
    high, low = edges[grades + 1] - score, edges[grades] - score
    upper, lower = _sigmoid(high), _sigmoid(low)
    inside = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper) / inside, lower * (1 - lower) / inside
    by_score = d_upper - d_lower
    by_weight = np.bincount(numbers, by_score[owner] * rates, len(weights))
    by_limit = np.zeros(len(limits))
    np.add.at(by_limit, grades[grades < len(limits)], -d_upper[grades < len(limits)])
    np.add.at(by_limit, grades[grades > 0] - 1, d_lower[grades > 0])
    # A step moves its own threshold and all above it.
    by_free = np.cumsum(by_limit[::-1])[::-1].copy()
    by_free[1:] *= np.exp(free[1:])
    return float(-np.log(inside).sum()), by_weight, by_free


def minimise(
    value_and_gradient: Callable[[np.ndarray], tuple[float, np.ndarray]],
    start: np.ndarray,
    steps: int,
    memory: int = 8,
) -> np.ndarray:
    """Limited-memory BFGS with step halving."""
    x, pairs = start, []
    value, gradient = value_and_gradient(x)
    for _ in range(steps):
        direction, used = gradient.copy(), []
        for s, y in reversed(pairs):
            a = (s @ direction) / (s @ y)
            direction -= a * y
            used.append(a)
        if pairs:
            s, y = pairs[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(1.0, float(np.abs(gradient).sum()))
        for (s, y), a in zip(pairs, reversed(used)):
            direction += s * (a - (y @ direction) / (s @ y))
        length = 1.0
        for _ in range(8):
            new = x - length * direction
            new_value, new_gradient = value_and_gradient(new)
            if new_value <= value - 1e-4 * length * (gradient @ direction):
                break
            length /= 2
        else:
            return x
        s, y = new - x, new_gradient - gradient
        if s @ y > 1e-12:
            pairs = (pairs + [(s, y)])[-memory:]
        done = value - new_value < 1e-5 * max(1.0, abs(value))
        x, value, gradient = new, new_value, new_gradient
        if done:
            break
    return x


_NUMBERS = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("numbers", pa.list_(pa.int32()))])
_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("toxic", pa.int32()),
        ("numbers", pa.list_(pa.int32())),
        ("rates", pa.list_(pa.float64())),
    ]
)


def _number_rows():
    def run(batches):
        features = Features()
        yield from per_row(
            _NUMBERS, lambda doc_id, toxic, text: (doc_id, toxic, features.of(text)[0])
        )(batches)

    return run


def _feature_rows(known):
    """Rows of the known features only, numbered by their place among them."""

    def run(batches):
        features = Features()

        def row(doc_id, toxic, text):
            numbers, rates = features.of(text)
            at = np.searchsorted(known.value, numbers)
            at[at == len(known.value)] = 0
            held = known.value[at] == numbers if len(known.value) else np.zeros(len(at), bool)
            return doc_id, toxic, at[held], rates[held]

        yield from per_row(_ROWS, row)(batches)

    return run


def _gradients(model):
    """The summed loss and gradient of a task's rows, cut into chunks."""

    def run(batches):
        weights, free = model.value
        total = None
        for batch in batches:
            lists = batch.column("numbers")
            sizes = np.diff(lists.offsets.to_numpy())
            loss, by_weight, by_free = loss_and_gradient(
                np.repeat(np.arange(len(sizes)), sizes),
                lists.flatten().to_numpy(),
                batch.column("rates").flatten().to_numpy(),
                batch.column("grade").to_numpy(),
                weights,
                free,
            )
            sums = np.concatenate([[loss], by_weight, by_free])
            total = sums if total is None else total + sums
        if total is None:
            return
        chunks = [total[at : at + _CHUNK].tobytes() for at in range(0, len(total), _CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(chunks)), pa.int32()),
                pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()),
                pa.array(chunks, pa.binary()),
            ],
            names=["chunk", "part", "sums"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of a chunk over all tasks, in their order, so that reruns agree."""
    rows = table.sort_by("part")
    sums = np.sum([np.frombuffer(part) for part in rows["sums"].to_pylist()], axis=0)
    return pa.table([rows["chunk"][:1], pa.array([sums.tobytes()], pa.binary())], names=["chunk", "sums"])


def severity_grades(rows: DataFrame, typical: np.ndarray) -> DataFrame:
    """Grade 0 for rows that are not toxic; 1 or 2 for the milder and severer half.

    A toxic row is the severer, the higher its summed rates of the features that
    are typical of toxic rows.
    """
    place = rows.sparkSession.createDataFrame(
        [(int(number),) for number in typical], "number int"
    )
    rate = (
        rows.where("toxic = 1")
        .select("doc_id", F.explode(F.arrays_zip("numbers", "rates")).alias("feature"))
        .select("doc_id", F.col("feature.numbers").alias("number"), "feature.rates")
        .join(place, "number")
        .groupBy("doc_id")
        .agg(F.sum("rates").alias("strength"))
    )
    toxic = rows.join(rate, "doc_id", "left").withColumn(
        "strength", F.coalesce("strength", F.lit(0.0))
    )
    middle = toxic.where("toxic = 1").agg(F.percentile("strength", F.lit(0.5)).alias("middle"))
    severe = F.col("strength") >= F.col("middle")
    grade = F.when(F.col("toxic") == 0, 0).when(severe, 2).otherwise(1)
    return toxic.join(F.broadcast(middle)).withColumn("grade", grade.cast("int"))


class SeverityModel:
    """Weights by hashed feature, and ordered thresholds."""

    def __init__(self, weights: np.ndarray, limits: np.ndarray) -> None:
        self.weights, self.limits = weights, limits


def fit(
    documents: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    sample: int = 10_000,
    parts: int = 12,
    least_rows: int = 3,
    penalty: float = 0.03,
    steps: int = 30,
) -> SeverityModel | None:
    """Fit the model on at most `sample` labelled documents.

    Those are the ones with the least hash of doc_id; a document with several
    labels counts as toxic if one says so. Features of fewer than `least_rows`
    sample rows are left out. Tasks sum losses and gradients of their rows, and a
    shuffle by chunks adds them up, so one vector at a time reaches the driver, of a
    length bounded by the number of hashed features.
    Without both toxic and other rows there is nothing to learn: None.
    """
    spark = documents.sparkSession
    chosen = scratch.write(
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample),
        "toxic_sample",
    )
    texts = scratch.write(
        documents.select(F.col("doc_id").cast("long"), "text")
        .join(chosen, "doc_id")
        .select("doc_id", "toxic", "text")
        .repartition(parts, "doc_id"),
        "toxic_texts",
    )
    totals = dict(texts.groupBy("toxic").count().collect())
    if set(totals) != {0, 1}:
        return None
    counts = (
        texts.mapInArrow(_number_rows(), "doc_id long, toxic int, numbers array<int>")
        .select("toxic", F.explode("numbers").alias("number"))
        .groupBy("number")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("rows"))
        .where(F.col("rows") >= least_rows)
        .orderBy("number")
        .toArrow()
    )
    known = counts["number"].to_numpy().astype(np.int64)
    toxic, rows = counts["toxic"].to_numpy(), counts["rows"].to_numpy()
    share = ((toxic + 0.5) / (totals[1] + 1)) / ((rows - toxic + 0.5) / (totals[0] + 1))
    typical = np.flatnonzero((toxic >= 5) & (share >= 8))
    sent = spark.sparkContext.broadcast(known)
    featured = scratch.write(
        texts.mapInArrow(
            _feature_rows(sent), "doc_id long, toxic int, numbers array<int>, rates array<double>"
        ),
        "toxic_features",
    )
    graded = scratch.write(
        severity_grades(featured, typical).select("numbers", "rates", "grade").repartition(parts),
        "toxic_grades",
    )

    def value_and_gradient(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, free = x[:-2], x[-2:]
        model = spark.sparkContext.broadcast((weights, free))
        found = (
            graded.mapInArrow(_gradients(model), "chunk int, part int, sums binary")
            .groupBy("chunk")
            .applyInArrow(_added, "chunk int, sums binary")
            .collect()
        )
        sums = np.concatenate([np.frombuffer(row["sums"]) for row in sorted(found)])
        # Else the driver keeps the weights of every step until it collects its garbage.
        model.destroy()
        return (
            float(sums[0] + penalty / 2 * (weights @ weights)),
            sums[1:] + np.concatenate([penalty * weights, [0.0, 0.0]]),
        )

    x = minimise(value_and_gradient, np.zeros(len(known) + 2), steps)
    weights = np.zeros(1 << _BITS)
    weights[known] = x[:-2]
    return SeverityModel(weights, thresholds(x[-2:]))


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("severity", pa.float64()),
        ("p_toxic", pa.float64()),
        ("grade", pa.int32()),
    ]
)


def _severities(model):
    def run(batches):
        weights, limits = model.value
        features = Features()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [features.of(text) for text in part.column("text").to_pylist()]
                score = np.array([weights[numbers] @ rates for numbers, rates in found])
                odds = grade_odds(score, limits)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(odds @ np.arange(odds.shape[1])),
                        pa.array(1 - odds[:, 0]),
                        pa.array(odds.argmax(axis=1), pa.int32()),
                    ],
                    schema=_SCORED,
                )

    return run


def score(documents: DataFrame, model: SeverityModel | None, reject_at: float = 0.3) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of each row of `documents`.

    `severity` is the expected grade, `grade` the likeliest one, and `toxic` says
    whether the odds of any grade above 0 reach `reject_at`. A null or empty
    text has no features, so it gets what the thresholds alone say; without a
    model, every row gets grade 0. A very long text is read whole, one row at a
    time. Repeated rows are scored one by one; other columns are ignored; an empty
    table gives no rows.
    """
    ids = documents.select(F.col("doc_id").cast("long"), "text")
    weights = np.zeros(1 << _BITS) if model is None else model.weights
    limits = np.array([np.inf, np.inf]) if model is None else model.limits
    sent = documents.sparkSession.sparkContext.broadcast((weights, limits))
    return ids.mapInArrow(
        _severities(sent), "doc_id long, severity double, p_toxic double, grade int"
    ).withColumn("toxic", F.col("p_toxic") >= reject_at)


def drop_toxic(documents: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """`documents` without the rejected ones.

    Each row is judged by its own text, whatever its doc_id; rows are told apart
    by 64 bits of hash of both.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
    scores = score(documents.select(row.alias("doc_id"), "text"), fit(documents, labels, scratch))
    gone = scratch.write(
        scores.where("toxic").select(F.col("doc_id").alias("__llm_gone")).distinct(), "toxic_rows"
    )
    return documents.join(gone, row == F.col("__llm_gone"), "left_anti")
