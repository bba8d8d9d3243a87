"""The prefix tree of conversations: which beginnings they share, and what that saves.

1. Turns are dictionary-encoded: each distinct (role, text) has a number.
2. Equal sequences of turns become one row with the number of its conversations.
3. Sequences are dealt out by range, so a shard holds neighbours in the order of
   the tree. Each shard builds a ternary search tree, inserting the median first,
   and walks it with a stack. Nodes that other shards cannot share are complete.
4. What is left of a shard are the prefixes of its first and of its last sequence.
   Those of neighbouring shards are merged, `_FAN` shards at a time, until one
   group is left; in each round the nodes between its ends become complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.llm.common import PAIR, hash_pair
from trailmetrics.runtime import Scratch

# Shards whose ends are merged by one task.
_FAN = 64
# Conversation ids that are joined into one row before they are hashed.
_CHUNK = 4096
_ROWS = 10_000
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_ROOT = bytes(16)
_FIRST, _LAST = 1, 2

_SCHEMA = (
    "edge int, shard int, position long, key binary, parent_key binary, token long, size long, "
    "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved long, ends string"
)
_ARROW = pa.schema(
    [
        ("edge", pa.int32()),
        ("shard", pa.int32()),
        ("position", pa.int64()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        *[
            (name, pa.int64())
            for name in (
                "token",
                "size",
                "depth",
                "conv_id",
                "parent_conv_id",
                "n_convs",
                "n_children",
                "n_leaves",
                "saved",
            )
        ],
        ("ends", pa.string()),
    ]
)


def sequences(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, tokens, sizes): each conversation's turns as numbers, and their bytes.

    Turns are in the order of `turn` (null first), then role, then the SHA-256 of
    the text; a null role or text is empty. Rows that repeat a turn are turns of
    their own. Rows without a conv_id belong to no conversation and are left out.
    Texts are hashed where they are, whole, and not moved. A conversation is one
    row, of some 16 bytes a turn.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = scratch.write(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.unhex(F.sha2(text, 256)).alias("text_hash"),
            F.octet_length(text).cast("long").alias("size"),
        ),
        "turns",
    )
    dictionary = scratch.write(
        turns.select("role", "text_hash")
        .distinct()
        .withColumn("token", F.monotonically_increasing_id()),
        "dictionary",
    )
    in_order = F.struct(F.col("turn").isNotNull(), "turn", "role", "text_hash", "token", "size")
    lists = (
        turns.join(dictionary, ["role", "text_hash"])
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(in_order)).alias("turns"))
    )
    return scratch.write(
        lists.select(
            "conv_id", F.col("turns.token").alias("tokens"), F.col("turns.size").alias("sizes")
        ),
        "sequences",
    )


def with_common_heads(given: DataFrame, family: int = 5, longest: int = 8) -> DataFrame:
    """`given` sequences, each begun with turns of the first conversation of its family.

    The family of c starts at c - c % `family`. The first h turns of that
    conversation (none if it is absent) stand before those that c has after its
    own first h, where h is the CRC-32 of c in decimal, modulo `longest` + 1.
    """
    number = F.col("conv_id")
    heads = given.where(number % family == 0).select(
        number.alias("head_id"),
        F.slice("tokens", 1, longest).alias("head_tokens"),
        F.slice("sizes", 1, longest).alias("head_sizes"),
    )
    h = F.pmod(F.crc32(number.cast("string").cast("binary")), F.lit(longest + 1)).cast("int")

    def begun(own: str, head: str):
        first = F.coalesce(F.slice(head, F.lit(1), h), F.array().cast("array<bigint>"))
        return F.concat(first, F.slice(own, h + 1, F.size(own)))

    return given.join(heads, number - number % family == F.col("head_id"), "left").select(
        "conv_id",
        begun("tokens", "head_tokens").alias("tokens"),
        begun("sizes", "head_sizes").alias("sizes"),
    )


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to `_CHUNK` sorted ids of one sequence, joined by commas."""

    def rows() -> Iterator[tuple]:
        run, key = [], None
        for batch in batches:
            for *own, number in zip(*(column.to_pylist() for column in batch.columns)):
                if run and (own != key or len(run) == _CHUNK):
                    yield *key, run[0], ",".join(map(str, run))
                    run = []
                key = own
                run.append(number)
        if run:
            yield *key, run[0], ",".join(map(str, run))

    yield from _batches(rows(), ("__llm_h1", "__llm_h2", "first_id", "ids"))


def _hashed_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of the ids of each sequence; runs come in order, one at a time."""

    def rows() -> Iterator[tuple]:
        digest, key = None, None
        for batch in batches:
            for *own, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if own == key:
                    digest.update(b",")
                else:
                    if key:
                        yield *key, digest.hexdigest()
                    digest, key = hashlib.sha256(), own
                digest.update(ids.encode())
        if key:
            yield *key, digest.hexdigest()

    yield from _batches(rows(), ("__llm_h1", "__llm_h2", "ends"))


def _batches(
    rows: Iterable[tuple], names: Iterable[str], schema: pa.Schema | None = None
) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        columns = zip(*ready)
        if schema is None:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    ready = []
    for row in rows:
        ready.append(row)
        if len(ready) == _ROWS:
            yield batch()
            ready = []
    if ready:
        yield batch()


def _distinct(given: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, n_convs, tokens, sizes, ends) of each distinct sequence.

    Copies are counted in each task first. Their ids are sorted by range over all
    tasks and joined to runs, so that one task hashes only runs of a sequence
    however many conversations have it.
    """
    keyed = scratch.write(given.select("*", *hash_pair(F.col("tokens"))), "keyed")
    groups = keyed.groupBy(*PAIR).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.first("tokens").alias("tokens"),
        F.first("sizes").alias("sizes"),
    )
    in_order = [*PAIR, "conv_id"]
    joined = (
        keyed.select(*in_order)
        .repartitionByRange(*in_order)
        .sortWithinPartitions(*in_order)
        .mapInArrow(_joined_ids, "__llm_h1 long, __llm_h2 long, first_id long, ids string")
    )
    hashed = (
        joined.repartition(*PAIR)
        .sortWithinPartitions(*PAIR, "first_id")
        .mapInArrow(_hashed_ids, "__llm_h1 long, __llm_h2 long, ends string")
    )
    return scratch.write(groups.join(hashed, PAIR).drop(*PAIR), "distinct")


@dataclass
class _Nodes:
    """Nodes of a part of the tree in the order of their paths, parents before children."""

    above: list[int] = field(default_factory=list)
    key: list = field(default_factory=list)
    token: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    conv: list[int] = field(default_factory=list)
    convs: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    saved: list[int] = field(default_factory=list)
    ends: list = field(default_factory=list)

    def add(self, above, key, token, size, depth, conv, convs, children, leaves, saved, ends):
        self.above.append(above)
        self.key.append(key)
        self.token.append(token)
        self.size.append(size)
        self.depth.append(depth)
        self.conv.append(conv)
        self.convs.append(convs)
        self.children.append(children)
        self.leaves.append(leaves)
        self.saved.append(saved)
        self.ends.append(ends)
        return len(self.above) - 1

    def rows(self, edge: list[int], shard: int) -> Iterator[tuple]:
        """Complete the nodes off the edges, children first, and give all as rows.

        A node on an edge keeps what its complete children add to it.
        """
        for i in range(len(edge) - 1, -1, -1):
            up = self.above[i]
            if edge[i]:
                continue
            self.leaves[i] = self.leaves[i] if self.children[i] else 1
            self.saved[i] += (self.convs[i] - 1) * self.size[i]
            if up >= 0:
                self.children[up] += 1
                self.leaves[up] += self.leaves[i]
                self.saved[up] += self.saved[i]
        for i, up in enumerate(self.above):
            # A parent that is not complete may yet find an earlier conversation.
            waits = up >= 0 and (edge[up] or self.key[up] is not None)
            yield (
                edge[i],
                shard,
                i,
                self.key[i],
                self.key[up] if waits else None,
                self.token[i],
                self.size[i],
                self.depth[i],
                self.conv[i],
                self.conv[up] if up >= 0 and not waits else None,
                self.convs[i],
                self.children[i],
                self.leaves[i],
                self.saved[i],
                self.ends[i],
            )


class TernaryTree:
    """A ternary search tree over sequences of numbers; node 0 is the empty sequence."""

    def __init__(self) -> None:
        self.token, self.size = [-1], [0]
        self.low, self.below, self.high = [0], [0], [0]
        self.conv, self.convs, self.ends = [None], [0], [None]

    def _new(self, token: int, size: int) -> int:
        self.token.append(token)
        self.size.append(size)
        for link in (self.low, self.below, self.high, self.convs):
            link.append(0)
        self.conv.append(None)
        self.ends.append(None)
        return len(self.token) - 1

    def _pass(self, at: int, conv: int, convs: int) -> None:
        self.convs[at] += convs
        if self.conv[at] is None or conv < self.conv[at]:
            self.conv[at] = conv

    def insert(self, conv: int, convs: int, tokens: list, sizes: list, ends: str) -> None:
        at = 0
        self._pass(at, conv, convs)
        for token, size in zip(tokens, sizes):
            links, place = self.below, at
            while (node := links[place]) and (own := self.token[node]) != token:
                links, place = (self.low if token < own else self.high), node
            if not node:
                node = self._new(token, size)
                links[place] = node
            at = node
            self._pass(at, conv, convs)
        self.ends[at] = ends

    def nodes(self) -> _Nodes:
        """All nodes in the order of their sequences, by a stack."""
        found = _Nodes()
        todo = [(0, -1, 0, True)]
        while todo:
            node, above, depth, is_open = todo.pop()
            if not is_open:
                todo.append((self.high[node], above, depth, False)) if self.high[node] else None
                todo.append((node, above, depth, True))
                todo.append((self.low[node], above, depth, False)) if self.low[node] else None
                continue
            at = found.add(
                above,
                None,
                self.token[node],
                self.size[node],
                depth,
                self.conv[node],
                self.convs[node],
                0,
                0,
                0,
                self.ends[node],
            )
            if self.below[node]:
                todo.append((self.below[node], at, depth + 1, False))
        return found


def _medians_first(count: int) -> Iterator[int]:
    todo = [(0, count)]
    while todo:
        first, after = todo.pop()
        if first < after:
            middle = (first + after) // 2
            yield middle
            todo += [(first, middle), (middle + 1, after)]


def _shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard, whose sequences come in order."""
    given = [
        row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))
    ]
    if not given:
        return
    tree = TernaryTree()
    for place in _medians_first(len(given)):
        tree.insert(*given[place])
    nodes = tree.nodes()
    edge = [0] * len(nodes.above)
    # The nodes of the first sequence come first, and that of the last comes last.
    for i in range(len(given[0][2]) + 1):
        edge[i] |= _FIRST
    i = len(edge) - 1
    while i >= 0:
        edge[i] |= _LAST
        i = nodes.above[i]
    for i, on_edge in enumerate(edge):
        if on_edge:
            above = nodes.above[i]
            step = b"" if above < 0 else nodes.key[above] + nodes.token[i].to_bytes(8)
            nodes.key[i] = xxhash.xxh3_128_digest(step) if step else _ROOT
    yield from _batches(nodes.rows(edge, TaskContext.get().partitionId()), (), _ARROW)


def _merge(is_last: bool) -> Callable[[pa.Table], pa.Table]:
    """A function that merges the edges of neighbouring shards.

    In the order of their paths, a node is the same as one of an earlier shard only
    if that one lies on the latest path.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("shard", "ascending"), ("position", "ascending")])
        given = table.to_pylist()
        ends = given[0]["shard"], given[-1]["shard"]
        nodes, edge, path = _Nodes(), [], []
        for row in given:
            depth = row["depth"]
            if depth < len(path) and nodes.key[path[depth]] == row["key"]:
                at = path[depth]
                nodes.conv[at] = min(nodes.conv[at], row["conv_id"])
                nodes.convs[at] += row["n_convs"]
                nodes.children[at] += row["n_children"]
                nodes.leaves[at] += row["n_leaves"]
                nodes.saved[at] += row["saved"]
                nodes.ends[at] = nodes.ends[at] or row["ends"]
            else:
                at = nodes.add(
                    path[depth - 1] if depth else -1,
                    row["key"],
                    row["token"],
                    row["size"],
                    depth,
                    row["conv_id"],
                    row["n_convs"],
                    row["n_children"],
                    row["n_leaves"],
                    row["saved"],
                    row["ends"],
                )
                edge.append(0)
                path[depth:] = [at]
            if not is_last:
                edge[at] |= row["edge"] & _FIRST if row["shard"] == ends[0] else 0
                edge[at] |= row["edge"] & _LAST if row["shard"] == ends[1] else 0
        shard = ends[0] // _FAN
        return pa.Table.from_batches(_batches(nodes.rows(edge, shard), (), _ARROW), _ARROW)

    return run


def prefix_trie(given: DataFrame, scratch: Scratch, shard_turns: int = 100_000) -> DataFrame:
    """One row per distinct prefix of the sequences `given` (conv_id, tokens, sizes).

    conv_id is the smallest of the conversations that begin with the prefix, depth
    its number of turns, parent_conv_id the parent's conv_id (null for the empty
    prefix), n_convs the number of conversations, n_children and n_leaves those of
    the children and of the childless nodes below (a childless node counts
    itself), saved the bytes of last turns that all but one conversation share,
    summed over the subtree, and ends_sha256 the hash of the ids, in order and
    joined by commas, of the conversations that end here.

    Sequences are compared by 128 bits of hash where copies are found, and token by
    token in the trees. Empty sequences end at the empty prefix. Without sequences
    there are no rows. A shard holds about `shard_turns` turns, or one sequence; a
    merge of `_FAN` shards holds the prefixes of twice as many sequences.
    """
    lists = _distinct(given, scratch)
    turns = lists.agg(F.sum(F.size("tokens") + 1)).first()[0] or 1
    columns = ("conv_id", "n_convs", "tokens", "sizes", "ends")
    parts = (
        lists.select(*columns)
        .repartitionByRange(-(-turns // shard_turns), "tokens")
        .sortWithinPartitions("tokens")
        .mapInArrow(_shard, _SCHEMA)
    )
    found = [scratch.write(parts, "nodes")]
    while True:
        edges = found[-1].where("edge <> 0")
        last = edges.agg(F.max("shard")).first()[0]
        if last is None:
            break
        merged = edges.groupBy(F.expr(f"shard div {_FAN}").alias("near")).applyInArrow(
            _merge(last < _FAN), _SCHEMA
        )
        found.append(scratch.write(merged, f"merged_{len(found)}"))
        if last < _FAN:
            break
    complete = found[0].where("edge = 0")
    for part in found[1:]:
        complete = complete.unionAll(part.where("edge = 0"))
    parents = complete.where("key IS NOT NULL").select(
        F.col("key").alias("own_key"), F.col("conv_id").alias("found_parent")
    )
    waiting = complete.where("parent_key IS NOT NULL").join(
        parents, F.col("parent_key") == F.col("own_key")
    )
    settled = complete.where("parent_key IS NULL")
    columns = [
        "conv_id",
        "depth",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved",
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    ]
    return settled.select(*columns, "parent_conv_id").unionAll(
        waiting.select(*columns, F.col("found_parent").alias("parent_conv_id"))
    )
