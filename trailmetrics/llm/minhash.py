"""Near-duplicate documents by similarity sketches of word shingles.

The sketch is the fast similarity sketch of Dahlgaard, Knudsen and Thorup
(2017): in round i every shingle is thrown into a hashed bin with the value
i plus a hashed fraction, each bin keeps its least value, and the rounds end when
no bin is empty. The last `bins` rounds throw every shingle into one given bin
each, so all bins are filled after twice as many rounds as bins at the latest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.llm.graph import components
from trailmetrics.llm.words import WordHashes, mix, per_row, runs, signed
from trailmetrics.runtime import Scratch

BINS = 128
_ROUND_KEYS = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUES_AT_ONCE = 1024
# Documents outside a cluster's largest component that meet a block at once.
_CHUNK = 2000


def shingles(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of runs of words; bytes.lower() changes A-Z only."""
    words = (text or b"").lower().split()
    return np.unique(runs(hashes.of(words), size))


def sketch(values: np.ndarray) -> np.ndarray:
    """One value for each bin, alike in two sets with the odds of their similarity."""
    least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    at_once = max(1, _VALUES_AT_ONCE // len(values))
    for first in range(0, 2 * BINS, at_once):
        rounds = np.arange(first, min(first + at_once, 2 * BINS))
        thrown = mix(values[None, :] ^ _ROUND_KEYS[rounds][:, None])
        hashed = (thrown & np.uint64(BINS - 1)).astype(np.int64)
        bins = np.where(rounds[:, None] < BINS, hashed, rounds[:, None] - BINS)
        value = (rounds.astype(np.uint64)[:, None] << np.uint64(56)) | (thrown >> np.uint64(8))
        np.minimum.at(least, bins.ravel(), value.ravel())
        if least.max() < np.iinfo(np.uint64).max:
            break
    return least


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of `rows` bins."""
    bands = values.reshape(-1, rows)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in bands.T:
        key = mix(key ^ column)
    return key


def _signature(size: int, rows: int):
    hashes = WordHashes()

    def row(doc_id, text):
        found = shingles(text, size, hashes)
        if not len(found):
            return doc_id, 0, 0, 0, []
        # Two sums of differently mixed hashes name the set.
        name = [int(signed(mix(found * np.uint64(k)).sum(keepdims=True))[0]) for k in (1, 3)]
        return doc_id, len(found), *name, signed(band_keys(sketch(found), rows))

    return row


_SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("name1", pa.int64()),
        ("name2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def _signatures(size: int, rows: int):
    # Built in the task, so that each worker has its own memory of words.
    return lambda batches: per_row(_SIGNATURE, _signature(size, rows))(batches)


def linked_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets of the similarity, as pairs of positions.

    A search from each set in turn compares it with those not reached yet, all
    at once. A set that is reached is not compared with others reached before,
    which keeps large groups of copies cheap and loses no component.
    """
    sizes = np.array([len(s) for s in sets])
    values, dense = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    own = [dense[end - size : end] for end, size in zip(ends, sizes)]
    mark = np.zeros(len(values), bool)
    links, left, queue = [], np.arange(len(sets)), []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        at = queue.pop()
        # Sizes that differ too much cannot be similar.
        near = left[(100 * sizes[left] >= percent * sizes[at]) & (100 * sizes[at] >= percent * sizes[left])]
        if not len(near):
            continue
        mark[own[at]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
        both = np.add.reduceat(mark[np.concatenate([own[i] for i in near])].astype(np.int64), starts)
        mark[own[at]] = False
        reached = near[100 * both >= percent * (sizes[at] + sizes[near] - both)]
        links += [(at, other) for other in reached]
        queue += list(reached)
        left = left[~np.isin(left, reached)]
    return links


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _confirm(size: int, percent: int):
    hashes = WordHashes()

    def group(table: pa.Table) -> pa.Table:
        by_cluster: dict[int, list[tuple[int, bytes]]] = {}
        columns = [table[name].to_pylist() for name in ("cluster", "doc_id", "text")]
        for cluster, doc_id, text in zip(*columns):
            by_cluster.setdefault(cluster, []).append((doc_id, text))
        links = []
        for members in by_cluster.values():
            found = [(doc_id, shingles(text, size, hashes)) for doc_id, text in members]
            # Rows without words come along where they share a doc_id with others.
            found = [(doc_id, values) for doc_id, values in found if len(values)]
            if len(found) > 1:
                sets = [values for _, values in found]
                links += [(found[a][0], found[b][0]) for a, b in linked_sets(sets, percent)]
        columns = zip(*links) if links else ([], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_LINK)

    return group


def near_duplicates(
    documents: DataFrame,
    scratch: Scratch,
    shingle: int = 5,
    percent: int = 75,
    rows: int = 4,
    block_shingles: int = 1_500_000,
    pivots: int = 64,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `documents`.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of distinct `shingle`-word shingles (fewer words: one shingle of all).
    Shingles are compared by 64 bits of hash.

    1. Documents of equal sets form a class; its smallest doc_id stands for it.
    2. Each representative's sketch is cut into bands of `rows` bins. Documents
       that share a band are tied to its smallest doc_id; the components of these
       ties are clusters. With 128 bins and 4 rows, a pair of similarity 0.75
       shares no band with odds of 5 in a million.
    3. In each cluster all links are confirmed on full sets. A cluster of more
       than `block_shingles` shingles is dealt into blocks; `pivots` documents of
       it are in every block. What is not in the largest component after that is
       compared with every block.
    4. Components of the confirmed links give the result.

    Null or empty texts have no shingles and are linked with nothing. Rows that
    share a doc_id are one document, linked if any of them is; a null doc_id
    is linked with nothing and kept. A very long text is taken whole, one row at a
    time. Other columns are ignored; an empty table gives no rows.
    """
    signed_docs = scratch.write(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
            _signatures(shingle, rows),
            "doc_id long, n_shingles long, name1 long, name2 long, bands array<long>",
        ),
        "signatures",
    )
    named = signed_docs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.write(
        named.groupBy("name1", "name2", "n_shingles").agg(F.min("doc_id").alias("first")), "classes"
    )
    copies = named.join(classes, ["name1", "name2", "n_shingles"]).select(
        F.col("doc_id").alias("u"), F.col("first").alias("v")
    ).where("u <> v")
    standing = named.join(
        classes.withColumnRenamed("first", "doc_id"),
        ["name1", "name2", "n_shingles", "doc_id"],
        "left_semi",
    )
    banded = scratch.write(standing.select("doc_id", F.explode("bands").alias("band")), "bands")
    shared = banded.groupBy("band").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    ties = (
        banded.join(shared.where("n > 1"), "band")
        .where("doc_id <> first")
        .select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    )
    clusters = components(ties, scratch, "ties")
    links = _confirmed(documents, clusters, standing, scratch, shingle, percent, block_shingles, pivots)
    found = components(links.unionAll(copies), scratch, "links")
    component = F.coalesce("component", "doc_id")
    return (
        signed_docs.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )


def _confirmed(
    documents: DataFrame,
    clusters: DataFrame,
    standing: DataFrame,
    scratch: Scratch,
    shingle: int,
    percent: int,
    block_shingles: int,
    pivots: int,
) -> DataFrame:
    """Links (u, v) that connect what is similar in each cluster."""
    sizes = standing.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    members = clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")).join(
        sizes, "doc_id"
    )
    members = scratch.write(members, "members")
    whole = members.groupBy("cluster").agg(F.sum("n_shingles").alias("all_shingles"))
    blocks = F.ceil(F.col("all_shingles") / block_shingles)
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    # Small clusters share a group of rows, so that few groups are called.
    groups = max(1, 4 * total // block_shingles)
    placed = scratch.write(
        members.join(whole, "cluster").select(
            "doc_id",
            "cluster",
            blocks.alias("blocks"),
            F.pmod(F.xxhash64("doc_id"), blocks).alias("block"),
            F.when(blocks > 1, F.col("cluster"))
            .otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(groups)))
            .alias("place"),
        ),
        "placed",
    )
    large = placed.where("blocks > 1")
    order = Window.partitionBy("cluster").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    chosen = large.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pivots)
    in_all = chosen.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "doc_id", "cluster", "blocks", "block", "place"
    )
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    confirm = _confirm(shingle, percent)

    def links_of(rows: DataFrame) -> DataFrame:
        # Both sides grow with the corpus: a merge at every size.
        return (
            texts.join(rows.hint("merge"), "doc_id")
            .select("place", "block", "cluster", "doc_id", "text")
            .groupBy("place", "block")
            .applyInArrow(confirm, "u long, v long")
        )

    links = scratch.write(links_of(placed.unionByName(in_all).distinct()), "confirmed")
    if large.isEmpty():
        return links
    found = components(links, scratch, "first_links").withColumnRenamed("node", "doc_id")
    parts = large.join(found, "doc_id", "left").withColumn(
        "part", F.coalesce("component", "doc_id")
    )
    counts = parts.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    largest = counts.groupBy("cluster").agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    others = (
        parts.join(largest, "cluster")
        .where("part <> largest")
        .select("doc_id", "cluster", "blocks", "place")
    )
    chunked = others.join(
        others.groupBy("cluster").agg(F.ceil(F.count("*") / _CHUNK).alias("chunks")), "cluster"
    ).withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("chunks")))
    sent = chunked.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select("doc_id", "cluster", "place", (F.col("block") * F.col("chunks") + F.col("chunk")).alias("block"))
    received = (
        large.join(chunked.select("cluster", "chunks").distinct(), "cluster")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("doc_id", "cluster", "place", (F.col("block") * F.col("chunks") + F.col("chunk")).alias("block"))
    )
    more = scratch.write(links_of(sent.unionByName(received).distinct()), "confirmed_rest")
    return links.unionAll(more)


def drop_near_duplicates(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """`documents` with one document of each group of near-duplicates.

    Each row is judged by its own text, whatever its doc_id: a document is a doc_id
    with a text, told apart by 64 bits of hash of both. Of a group, the one with
    the smallest doc_id stays, a null doc_id after all others; rows that repeat a
    document stay or go together. Rows without words stay. Other columns pass
    unchanged; an empty table stays empty.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
    rows = documents.select(row.alias("doc_id"), "text")
    found = near_duplicates(rows, scratch).where("n_shingles > 0")
    ids = documents.select(row.alias("row"), F.col("doc_id").cast("long").alias("id")).distinct()
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "row")
    grouped = scratch.write(
        found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
        .distinct()
        .join(ids, "row")
        .select("row", "group", place.alias("place")),
        "grouped",
    )
    first = grouped.groupBy("group").agg(F.min("place")["row"].alias("first"))
    gone = grouped.join(first, "group").where("row <> first").select(F.col("row").alias("__llm_gone"))
    return documents.join(scratch.write(gone, "gone"), row == F.col("__llm_gone"), "left_anti")
