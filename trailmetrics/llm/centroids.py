"""Cluster vectors around centroids, with an exact progressive search for the nearest.

Vectors and centroids are integers, and go through a Walsh-Hadamard transform that
keeps them so: the squared distance is a 64th of the squared differences of all 64
coefficients. Coefficients are taken from coarse to fine. The sum over the first
ones is a lower bound, so a centroid whose sum is above the whole distance of
another one is out; those that are left are summed over all 64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.runtime import Scratch

WIDTH = 64
SCALE = 64
# The coefficients are added in these blocks.
_BLOCKS = (0, 4, 8, 16, 32, WIDTH)
# Below this, all sums of squares fit 64 bits; beyond it, whole numbers without a
# limit are used.
_SMALL = 2**24
_ROWS = 2048


def _butterflies(values: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, by sums and differences."""
    step = 1
    while step < WIDTH:
        pairs = values.reshape(-1, WIDTH // (2 * step), 2, step)
        left, right = pairs[:, :, 0], pairs[:, :, 1]
        values = np.stack([left + right, left - right], axis=2).reshape(-1, WIDTH)
        step *= 2
    return values


# Coarse to fine: by the number of sign changes of a coefficient's pattern.
_SIGNS = _butterflies(np.eye(WIDTH, dtype=np.int64))
_COARSE_FIRST = np.argsort((np.diff(_SIGNS, axis=0) != 0).sum(axis=0))


def transform(values: np.ndarray) -> np.ndarray:
    """The coefficients of each row, from coarse to fine."""
    return _butterflies(values)[:, _COARSE_FIRST]


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 * x) of each component, without rounding at any size."""
    scaled = np.floor(vectors * SCALE)
    if scaled.size == 0 or np.abs(scaled).max() < _SMALL:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.flat], object).reshape(scaled.shape)


def _whole(rows: list[list[int]]) -> np.ndarray:
    large = any(abs(x) >= _SMALL for row in rows for x in row)
    return np.array(rows, object if large else np.int64).reshape(-1, WIDTH)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (the first of equals) and its squared distance."""
    own, others = transform(vectors), transform(centroids)
    if object in (own.dtype, others.dtype):
        own, others = own.astype(object), others.astype(object)
    start = own[:, None, : _BLOCKS[1]] - others[None, :, : _BLOCKS[1]]
    sums = (start * start).sum(axis=2)
    # The whole distance of the likeliest one bounds that of the nearest.
    rest = own - others[sums.argmin(axis=1)]
    bound = (rest * rest).sum(axis=1)
    alive = sums <= bound[:, None]
    for first, last in pairwise(_BLOCKS[1:]):
        rows, columns = np.nonzero(alive)
        rest = own[rows, first:last] - others[columns, first:last]
        sums[rows, columns] += (rest * rest).sum(axis=1)
        alive[rows, columns] = sums[rows, columns] <= bound[rows]
    found = np.where(alive, sums, sums.max() + 1).argmin(axis=1)
    return found, sums[np.arange(len(found)), found] // WIDTH


def _kept(embedding: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    whole = (F.size(embedding) == WIDTH) & F.forall(embedding, finite)
    return F.coalesce(whole, F.lit(False))


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            numbers = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            yield part, integers(numbers.reshape(-1, WIDTH))


def _seeds(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose seeded hash of the id is smallest; equal ids by components.

    The driver gets k hashes from a task, then the vectors of k rows.
    """
    label = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    # Rows without an id come last.
    order = F.coalesce(F.sha2(label, 256), F.lit("none"))
    hashed = vectors.withColumn("__llm_order", order)
    last = hashed.select("__llm_order").orderBy("__llm_order").limit(k).agg(F.max("__llm_order"))
    bound = last.first()[0]
    if bound is None:
        return []
    first = hashed.where(F.col("__llm_order") <= bound).orderBy("__llm_order", "embedding").limit(k)
    found = np.array([row["embedding"] for row in first.collect()], np.float64)
    return integers(found.reshape(-1, WIDTH)).tolist()


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid moved to the mean of its vectors, rounded down.

    A task sends one row of sums per centroid; the driver gets the k means.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _whole(centroids)
        counts = np.zeros(len(points), np.int64)
        sums = np.zeros(points.shape, object)
        for _, matrix in _matrices(batches):
            found, _ = nearest(matrix, points)
            for c in np.unique(found):
                own = matrix[found == c]
                counts[c] += len(own)
                sums[c] += own.sum(axis=0)
        for c in np.flatnonzero(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c] * WIDTH, pa.int32()),
                    pa.array(range(WIDTH), pa.int32()),
                    pa.array([counts[c]] * WIDTH, pa.int64()),
                    pa.array(sums[c].tolist(), pa.int64()),
                ],
                names=["cluster", "place", "n", "total"],
            )

    parts = vectors.select("embedding").mapInArrow(run, "cluster int, place int, n long, total long")
    sums = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    moved = [list(centroid) for centroid in centroids]
    for row in sums.collect():
        moved[row["cluster"]][row["place"]] = int(row["total"]) // row["n"]
    return moved


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, __llm_cluster, __llm_distance) of each vector."""
    schema = vectors.select("vec_id").schema
    schema = schema.add("__llm_cluster", "integer").add("__llm_distance", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _whole(centroids)
        for part, matrix in _matrices(batches):
            found, distances = nearest(matrix, points)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    pa.array(found, pa.int32()),
                    pa.array(distances.tolist(), pa.int64()),
                ],
                names=schema.names,
            )

    return vectors.mapInArrow(run, schema)


def cluster(
    vectors: DataFrame, scratch: Scratch, k: int = 16, rounds: int = 3, seed: int = 1
) -> DataFrame:
    """The cluster of each row of `vectors` (vec_id, embedding) after `rounds` rounds.

    Returns vec_id, __llm_cluster, __llm_distance (squared, in 64ths of the
    components), __llm_centroid (whole numbers), __llm_cluster_inertia and
    __llm_inertia (distances summed over the cluster and over all).

    Rows whose embedding is null, has another length than 64, or holds nulls,
    NaN or infinities are left out. Ties go to the smaller cluster number. Each
    repeated row counts, and may be a first centroid of its own; a null vec_id
    comes after all others among those. With fewer than `k` vectors there are as
    many clusters; an empty table gives no rows. Other columns are ignored. A
    distance beyond 64 bits (components of some millions) ends the job with an
    error.

    Only centroids, k rows, are at the driver; each round is one pass over the
    embeddings, without a shuffle but for k rows of sums from each task.
    """
    kept = vectors.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    ).where(_kept(F.col("embedding")))
    centroids = _seeds(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids)
    assigned = scratch.write(_assigned(kept, centroids), "assigned")
    sums = assigned.groupBy("__llm_cluster").agg(F.sum("__llm_distance").alias("inertia"))
    inertia = {row["__llm_cluster"]: row["inertia"] for row in sums.collect()}
    traits = assigned.sparkSession.createDataFrame(
        [(c, centroids[c], total, sum(inertia.values())) for c, total in inertia.items()],
        "__llm_cluster int, __llm_centroid array<long>, __llm_cluster_inertia long, "
        "__llm_inertia long",
    )
    # At most k rows.
    return assigned.join(F.broadcast(traits), "__llm_cluster")
