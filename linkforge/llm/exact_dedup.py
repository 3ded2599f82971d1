"""Exact dedup (operator 7): owners in Patricia tries.

Two texts are equal when their bytes are, white space removed. Two passes
insert full byte strings into compressed radix tries whose terminal nodes
hold the smallest identifier seen:

1. inside the scan's tasks, so a text copied thousands of times leaves a task
   once. Each row gets the local owner of its text; only the owner's row
   carries bytes. The outcome is a written table.
2. the owners' bytes are dealt by (length, content hash) and inserted into
   the task's trie, which maps every local owner to its smallest equal one.
   The hash only deals; equality is decided on the bytes.

From there on only narrow columns move: counts and the best row by local
owner, then by final owner, then back to the rows.

Memory: a trie holds at most ``trie_bytes`` of strings. Beyond that its
heaviest subtree under the root is spilled: in pass 1 it is forgotten (a later
copy becomes one more local owner), in pass 2 its terminals, and all later
ones below the same edge, go to a written table with their bytes and meet
again in another round over more partitions. Spills live in the shared
checkpoint folder, so a lost executor costs a task, not the round.

Skew: a text has at most one row per scan task (and spill) after pass 1.

Edge cases: null text counts as empty; an empty text equals any text of white
space only. Of equal texts the one with most code points, then the smallest
id stays (a null id last). ``kept`` marks every row whose id is keep_id, so a
row repeated with its id is marked each time. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CHARS, partitions_for

TRIE_BYTES = 256 << 20
PARTITION_BYTES = 64 << 20
_YIELD_BYTES = 16 << 20
_ROW_BITS = 40  # local owner = task << 40 | row within the task
_SPACES = SPACE_CHARS.encode()


class Node:
    """Edge label = source[start:end]; ``owners`` is None on inner nodes."""

    __slots__ = ("source", "start", "end", "children", "owners")

    def __init__(self, source: bytes, start: int, end: int):
        self.source, self.start, self.end = source, start, end
        self.children: dict[int, Node] = {}
        self.owners = None


def _shared(a: bytes, i: int, b: bytes, j: int, most: int) -> int:
    """Length of the common prefix of a[i:] and b[j:], at most ``most``
    (halving: the prefix of length ``low`` is known to be equal)."""
    low = 0
    while low < most:
        half = (low + most + 1) // 2
        if a[i + low:i + half] == b[j + low:j + half]:
            low = half
        else:
            most = half - 1
    return low


class PatriciaTrie:
    def __init__(self):
        self.root = Node(b"", 0, 0)
        self.held: dict[int, int] = {}  # bytes kept below each edge of the root
        self.bytes = 0

    def insert(self, key: bytes) -> Node:
        """The terminal node of ``key``, made if it isn't there."""
        node, at, size = self.root, 0, len(key)
        while at < size:
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key, at, size)
                self.held[key[0]] = self.held.get(key[0], 0) + size
                self.bytes += size
                return child
            width = child.end - child.start
            if key[at:at + width] != child.source[child.start:child.end]:
                width = _shared(key, at, child.source, child.start, min(width, size - at))
                upper = Node(child.source, child.start, child.start + width)
                child.start += width
                upper.children[child.source[child.start]] = child
                node.children[key[at]] = upper
                child = upper
            node, at = child, at + width
        return node

    @staticmethod
    def terminals(top: Node) -> Iterator[tuple[Node, bytes]]:
        """Nodes with owners below ``top`` with their full strings."""
        stack = [(top, b"")] if top.start == 0 else []
        while stack:
            node, above = stack.pop()
            key = above + node.source[node.start:node.end]
            if node.owners is not None:
                yield node, key
            stack += [(c, key) for c in node.children.values()]

    def spill(self) -> tuple[int, Node]:
        """Takes out the heaviest subtree under the root."""
        edge = max(self.held, key=self.held.get)
        self.bytes -= self.held.pop(edge)
        return edge, self.root.children.pop(edge)


def _normal(text: str) -> bytes:
    return text.encode().translate(None, _SPACES)


_LOCAL = "owner bigint, code_points bigint, text_sha256 string, n_bytes bigint, hash bigint, key binary"


def local_owners(documents: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Pass 1: doc_id, owner, code_points, text_sha256, n_bytes, hash, key
    (key on the owner's own row only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, row = PatriciaTrie(), TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            rows, since, weight = [], 0, 0
            ids = batch.column(0)
            for k, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                key = _normal(text)
                node = trie.insert(key)
                fresh = node.owners is None
                if fresh:
                    node.owners = (row, hashlib.sha256(key).hexdigest(), xxhash.xxh64_intdigest(key) - (1 << 63))
                    weight += len(key)
                owner, sha, mixed = node.owners
                rows.append((owner, len(text), sha, len(key), mixed, key if fresh else None))
                row += 1
                if weight > _YIELD_BYTES:
                    yield _rows(ids.slice(since, len(rows)), rows)
                    rows, since, weight = [], k + 1, 0
                while trie.bytes > trie_bytes:
                    trie.spill()
            yield _rows(ids.slice(since, len(rows)), rows)

    def _rows(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(cols, types))],
                                          names=["doc_id", "owner", "code_points", "text_sha256", "n_bytes", "hash", "key"])

    narrow = documents.select("doc_id", "text")
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {_LOCAL}")


_MERGED = "owner bigint, final bigint, n_bytes bigint, hash bigint, key binary"


def _merge_round(owners: DataFrame, partitions: int, trie_bytes: int) -> DataFrame:
    """One trie per task. Rows without key map owner -> final; rows with key
    are spilled terminals (owner = final) for the next round."""

    def flush(terminals: Iterator[tuple[Node, bytes]], carry: bool) -> Iterator[pa.RecordBatch]:
        rows, weight = [], 0
        for node, key in terminals:
            final = min(node.owners)
            rows += [(o, final, None, None, None) for o in node.owners]
            if carry:
                rows.append((final, final, len(key), xxhash.xxh64_intdigest(key) - (1 << 63), key))
                weight += len(key)
            if weight > _YIELD_BYTES or len(rows) > 50_000:
                yield batch_of(rows)
                rows, weight = [], 0
        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 5
        types = [pa.int64()] * 4 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["owner", "final", "n_bytes", "hash", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, spilled = PatriciaTrie(), set()
        for batch in batches:
            for owner, key in zip(batch.column(0).to_pylist(), batch.column(1)):
                node = trie.insert(key.as_py())
                if node.owners is None:
                    node.owners = []
                node.owners.append(owner)
                while trie.bytes > trie_bytes:
                    edge, subtree = trie.spill()
                    spilled.add(edge)
                    yield from flush(PatriciaTrie.terminals(subtree), True)
        if trie.root.owners is not None:
            yield from flush(iter([(trie.root, b"")]), False)
        for edge, subtree in trie.root.children.items():
            yield from flush(PatriciaTrie.terminals(subtree), edge in spilled)

    dealt = owners.repartition(partitions, "n_bytes", "hash").select("owner", "key")
    return dealt.mapInArrow(run, _MERGED)


def merge_owners(owners: DataFrame, trie_bytes: int = TRIE_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Pass 2: owner -> final owner for every local owner. Texts that no trie
    of ``trie_bytes`` can hold are compared by their stored bytes, within their
    length and hash."""
    spark = owners.sparkSession
    long_texts, owners = owners.where(F.col("n_bytes") > trie_bytes), owners.where(F.col("n_bytes") <= trie_bytes)
    same = long_texts.groupBy("n_bytes", "hash", "key").agg(F.min("owner").alias("final"))
    of_long = long_texts.select("owner", "n_bytes", "hash", "key").join(same, ["n_bytes", "hash", "key"]).select("owner", "final")
    total = owners.agg(F.sum("n_bytes")).first()[0] or 0
    partitions = partitions_for(spark, total, partition_bytes)
    merged = materialize(_merge_round(owners, partitions, trie_bytes), "trie-owners")
    finals = merged.where(F.col("key").isNull()).select("owner", "final")
    spilled = merged.where(F.col("key").isNotNull())
    while not spilled.isEmpty():
        partitions *= 4
        merged = materialize(_merge_round(spilled, partitions, trie_bytes), "trie-owners")
        later = merged.where(F.col("key").isNull()).select(F.col("owner").alias("final"), F.col("final").alias("later"))
        finals = materialize(finals.join(later, "final", "left")
                                   .select("owner", F.coalesce("later", "final").alias("final")), "trie-finals")
        spilled = merged.where(F.col("key").isNotNull())
    return finals.unionByName(of_long)


def exact_duplicates(documents: DataFrame, trie_bytes: int = TRIE_BYTES,
                     partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    local = materialize(local_owners(documents, trie_bytes), "local-owners")
    finals = merge_owners(local.where(F.col("key").isNotNull()).select("owner", "n_bytes", "hash", "key"),
                          trie_bytes, partition_bytes)
    rank = F.struct((-F.col("code_points")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"),
                    F.col("doc_id").alias("doc_id"))
    by_owner = (local.groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("best"))
                     .join(finals, "owner"))
    by_final = by_owner.groupBy("final").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    answer = (by_owner.select("owner", "final").join(by_final, "final")
                      .select("owner", F.col("best.doc_id").alias("keep_id"), "group_size"))
    return (local.select("doc_id", "owner", "text_sha256").join(answer, "owner")
                 .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         "text_sha256"))
