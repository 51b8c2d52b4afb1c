"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: one digest a turn, of its role and text. Paths sorted by
``(path, conversation)`` have every subtree of the trie in one stretch. A sample of paths gives
splitters that cut this order into shards; conversations with one path are told apart by their
number, so a hot conversation is cut as well. The trie of the splitter paths, the skeleton, is
broadcast: a node outside it lies between two splitters, so that one shard has all its members.
Each task sorts its shards, walks their paths with a stack of open nodes, finishes all nodes
outside the skeleton and gives partial aggregates of those inside. These are reduced by node; what
remains, the sums up the skeleton, is work on the broadcast trie alone.

Bounds: the expected bytes of sampled splitter paths are ``SPLITTER_BYTES``, which bounds the
broadcast trie and what the driver gets back; a shard has about ``SHARD_TURNS`` turns. Texts are
read once and never shuffled: a turn travels as 16 bytes and a count. Conversations that end at a
node of the skeleton, which may be a third of all, come as one chunk of digits a shard and are
hashed chunk by chunk, in order. A conversation itself is one row, of 20 bytes a turn.

Defined cases: null role or text is empty; rows without ``conv_id`` belong to no conversation and
are left out; turns of one number are ordered by their digest, so that repeated rows are turns of
their own; null turns come first; an empty table gives an empty result, without a root; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmesh.llm.common import words, written

EVERY, HEADS = 20, 4  # a conversation's first turns come from the last multiple of 20 below
SHARD_TURNS = 200_000
SPLITTER_BYTES = 8 << 20
OVERSAMPLE = 16
DIGEST = 16
_EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
#: Rows of a shard: finished nodes, and parts of skeleton nodes (those with ``part_of``).
_ROWS = f"{NODE}, below int, part_of int, shard int, words bigint, ends binary"


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of a turn, as 32 hexadecimal digits."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def conversations_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as ``(turn, digest, words)``."""
    role, text = F.coalesce(rows[role_col], F.lit("")), F.coalesce(rows[text_col], F.lit(""))
    turn = F.struct(rows[turn_col].alias("turn"), F.unhex(turn_digest(role, text)).alias("digest"), F.size(words(text)).alias("words"))
    given = rows.select(rows[conv_col].cast("bigint").alias("conv_id"), turn.alias("turn")).where("conv_id IS NOT NULL")
    return given.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(found: DataFrame, every: int = EVERY, heads: int = HEADS) -> DataFrame:
    """Conversations whose first h turns are those of conversation ``c - c % every``; h is
    ``crc32(c) % heads``. An ``every`` of conversations at most share one: the join has no hot key."""
    first = found.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, heads - 1).alias("_head"))
    own = found.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every)
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("_head", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return own.join(first, "_base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def as_paths(found: DataFrame) -> DataFrame:
    """``conv_id, path, words``: the digests of the turns, one behind the other."""
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return found.select("conv_id", F.unhex(hexed).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))


@dataclass
class Skeleton:
    """The splitters in order, and the trie of their paths; node 0 is the root."""

    splitters: list[tuple[bytes, int]]
    children: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    parents: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        for path, _ in self.splitters:
            at = 0
            for d in range(0, len(path), DIGEST):
                turn = path[d : d + DIGEST]
                if turn not in self.children[at]:
                    self.children[at][turn] = len(self.children)
                    self.children.append({})
                    self.parents.append(at)
                at = self.children[at][turn]


def skeleton(paths: DataFrame, shards: int | None = None, splitter_bytes: int = SPLITTER_BYTES) -> Skeleton:
    """Splitters at even places of a sample chosen by a hash, about ``shards`` of them."""
    total = paths.agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("turns"), F.sum(F.length("path") + 40).alias("bytes")).first()
    if not total["n"]:
        return Skeleton([])
    shards = shards or max(2 * paths.sparkSession.sparkContext.defaultParallelism, -(-(total["turns"] + total["n"]) // SHARD_TURNS))
    share = min(1.0, OVERSAMPLE * shards / total["n"], splitter_bytes / total["bytes"])
    chosen = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = sorted((bytes(r["path"]), r["conv_id"]) for r in paths.where(chosen).select("path", "conv_id").toLocalIterator())
    return Skeleton(sorted({sample[len(sample) * k // shards] for k in range(1, shards)}) if sample else [])


@dataclass
class _Open:
    """A node whose subtree is being walked: what is known of it so far."""

    words: int
    known: int | None  # its number in the skeleton
    conv: int | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: list[int] = field(default_factory=list)
    rows: list[list] = field(default_factory=list)  # of its finished children, if it isn't in the skeleton


def walk(shard: int, rows: Iterator[tuple[bytes, int, list[int]]], trie: list[dict[bytes, int]]) -> Iterator[list]:
    """Result rows of one shard's ``(path, conversation, words)``, in the order of the shard."""
    stack = [_Open(0, 0)]
    before = b""

    def close() -> Iterator[list]:
        node = stack.pop()
        depth = len(stack)
        for row in node.rows:
            row[2] = node.conv
            yield row
        up = stack[-1] if stack else None
        digits = ",".join(map(str, node.ends)).encode()
        if node.known is None:
            node.leaves += not node.children
            node.saved += (node.n - 1) * node.words
            up.children += 1
            sha = hashlib.sha256(digits).hexdigest()
            row = [node.conv, depth, None, node.n, node.children, node.leaves, node.saved, sha, up.known, None, shard, None, None]
            if up.known is None:
                up.rows.append(row)  # until the parent's smallest member is known
            else:
                yield row
        else:
            yield [node.conv, depth, None, node.n, node.children, node.leaves, node.saved, None, None, node.known, shard, node.words, digits or None]
        if up:
            up.n += node.n
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
            up.leaves += node.leaves
            up.saved += node.saved

    for path, conv, counts in rows:
        shared, most = 0, min(len(path), len(before))
        while shared < most and path[shared : shared + DIGEST] == before[shared : shared + DIGEST]:
            shared += DIGEST
        while len(stack) - 1 > shared // DIGEST:
            yield from close()
        for d in range(shared // DIGEST, len(path) // DIGEST):
            above = stack[-1].known
            known = None if above is None else trie[above].get(path[d * DIGEST : (d + 1) * DIGEST])
            stack.append(_Open(counts[d], known))
        node = stack[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.ends.append(conv)
        before = path
    while stack:
        yield from close()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Consecutive rows of one shard at a time."""

    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(b.column("shard").to_pylist(), b.column("path").to_pylist(), b.column("conv_id").to_pylist(), b.column("words").to_pylist(), strict=True)

    all_rows = rows()
    row = next(all_rows, None)
    while row is not None:
        shard = row[0]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == shard:  # noqa: B023
                yield row[1:]
                row = next(all_rows, None)

        yield shard, own()


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("below", pa.int32()), ("part_of", pa.int32()), ("shard", pa.int32()), ("words", pa.int64()), ("ends", pa.binary())])


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def walked(paths: DataFrame, frame: Skeleton) -> DataFrame:
    """The rows of all shards: finished nodes, and parts of the skeleton's."""
    shared = paths.sparkSession.sparkContext.broadcast((frame.splitters, frame.children))
    deal = pa.schema([("shard", pa.int32()), ("path", pa.binary()), ("conv_id", pa.int64()), ("words", pa.list_(pa.int32()))])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shared.value[0]
        for b in batches:
            keys = zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect_right(splitters, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, b.column("path").cast(pa.binary()), b.column("conv_id"), b.column("words").cast(deal[3].type)], schema=deal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value[1]
        held = []
        for shard, rows in _shards(batches):
            for row in walk(shard, rows, trie):
                held.append(row)
                if len(held) >= 10_000:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)

    by_shard = paths.select("path", "conv_id", "words").mapInArrow(dealt, "shard int, path binary, conv_id bigint, words array<int>")
    by_shard = by_shard.repartition(len(frame.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return by_shard.mapInArrow(run, _ROWS)


def _hashed(parts: DataFrame) -> DataFrame:
    """``part_of, ends_sha256``: the chunks of each node hashed in order, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []
        for b in batches:
            for k, ends in zip(b.column("part_of").to_pylist(), b.column("ends"), strict=True):
                if k != node:
                    if sha:
                        done.append((node, sha.hexdigest()))
                    node, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ends.as_buffer())
        if sha:
            done.append((node, sha.hexdigest()))
        if done:
            yield pa.RecordBatch.from_pydict({"part_of": pa.array([k for k, _ in done], pa.int32()), "ends_sha256": pa.array([s for _, s in done])})

    chunks = parts.where("ends IS NOT NULL").select("part_of", "shard", "ends")
    return chunks.repartition("part_of").sortWithinPartitions("part_of", "shard").mapInArrow(run, "part_of int, ends_sha256 string")


def _finished(frame: Skeleton, parts: DataFrame) -> list[tuple]:
    """``(number, *NODE)`` of the skeleton's nodes, from their reduced parts: one row each."""
    reduced = parts.groupBy("part_of").agg(
        F.min("conv_id").alias("conv"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.sum("n_convs").alias("n"),
        F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    by_node = {r["part_of"]: r.asDict() for r in reduced.collect()}
    sha = {r["part_of"]: r["ends_sha256"] for r in _hashed(parts).collect()}
    for k, up in enumerate(frame.parents):
        if up >= 0:
            by_node[up]["children"] += 1
    for k in range(len(frame.parents) - 1, -1, -1):  # children have higher numbers than parents
        node, up = by_node[k], frame.parents[k]
        own = (int(not node["children"]), (node["n"] - 1) * node["words"])
        node["more"] = tuple(map(sum, zip(own, node.get("more", (0, 0)), strict=True)))
        if up >= 0:
            by_node[up]["more"] = tuple(map(sum, zip(by_node[up].get("more", (0, 0)), node["more"], strict=True)))
    return [
        (k, x["conv"], x["depth"], by_node[up]["conv"] if up >= 0 else None, x["n"], x["children"], x["leaves"] + x["more"][0], x["saved"] + x["more"][1], sha.get(k, _EMPTY))
        for k, up in enumerate(frame.parents)
        for x in [by_node[k]]
    ]


def trie_of(found: DataFrame, shards: int | None = None, splitter_bytes: int = SPLITTER_BYTES) -> DataFrame:
    """One row per node of the trie of ``conv_id, turns`` (see :func:`conversations_of`):
    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    spark = found.sparkSession
    paths = written(as_paths(found), "trie-paths")
    frame = skeleton(paths, shards, splitter_bytes)
    empty = spark.createDataFrame([], NODE)
    rows = written(walked(paths, frame), "trie-rows")
    parts = rows.where("part_of IS NOT NULL")
    if parts.isEmpty():
        return empty
    schema = T.StructType([T.StructField("_node", T.IntegerType()), *empty.schema.fields])
    top = spark.createDataFrame(_finished(frame, parts), schema)
    up = F.broadcast(top.select(F.col("_node").alias("below"), F.col("conv_id").alias("_up")))  # SPLITTER_BYTES bounds it
    nodes = rows.where("part_of IS NULL").join(up, "below", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
    return nodes.select(*empty.columns).union(top.drop("_node"))


def conversation_trie(rows: DataFrame, shards: int | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of all rebuilt conversations."""
    return trie_of(rebuilt(written(conversations_of(rows, conv_col, turn_col, role_col, text_col), "conversations")), shards)
