"""SimHash near-dedup (operator 5): BK-trees over shards of fingerprints.

A fingerprint holds 64 majority bits over the XXH64 hashes (seed 42) of the
lower-cased text's word shingles, repeats included. Documents with equal
fingerprints form a class; classes link at ``max_bits`` or fewer differing
bits.

Two fingerprints that differ in at most r bits agree on one of r + 1 equal
blocks of bits. So every class is filed in r + 1 shards, one for each block's
value, and all links lie inside shards. A shard's fingerprints form a BK-tree
(children keyed by their integer Hamming distance to the parent); a query at
distance d from a node follows only the edges d - r .. d + r. A shard larger
than ``cell_rows`` is cut into parts: the tree of each part is sent to all
query parts of its shard, one task call for each (part, part) cell.

Links don't leave a task one by one: each call keeps a union-find and emits
its spanning forest, from which connected components follow by the library's
large-star / small-star rounds. Fingerprints never gather in the driver.

Edge cases: null text counts as empty; a text without words has fingerprint
zero, linked like any other; one with fewer words than a shingle hashes its
whole sequence. Repeated rows share class and component. An empty table gives
no rows. component_id is the smallest non-null id of the component.

Scale: shards have n / 2^(64 / (r + 1)) classes each if bits are spread
evenly. At 10^10 classes that is 150,000 per shard; ``blocks`` > r + 1 files
every class by each choice of blocks - r blocks instead, which shortens the
shards (blocks = 6: 32 bits, 20 shards a class).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import component_labels
from ..session import materialize
from .cells import Forest, deal_cells

SHINGLE = 3
MAX_BITS = 3
HASH_SEED = 42
CELL_ROWS = 2048
GROUP_ROWS = 200_000
_SLICE = 1 << 14  # shingles whose bits are unpacked at a time
_MASK = (1 << 64) - 1


def text_fingerprint(text: str, shingle: int = SHINGLE, seed: int = HASH_SEED) -> int:
    """Unsigned 64-bit fingerprint."""
    words = text.encode().lower().split()  # both are ASCII-only on bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, ends = np.append(0, ends[:len(words) - shingle] + 1), ends[shingle - 1:]
    del words
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for s in range(0, len(ends), _SLICE):
        places = zip(starts[s:s + _SLICE].tolist(), ends[s:s + _SLICE].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in places], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    major = set_bits * 2 > len(ends)
    return int.from_bytes(np.packbits(major, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = HASH_SEED) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((text_fingerprint(t.as_py() or "", shingle, seed) for t in batch.column(1)),
                                np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    narrow = documents.select("doc_id", "text")
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp bigint")


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0 if self.values else None
        self.values.append(value)
        self.children.append({})
        while at is not None:
            d = (self.values[at] ^ value).bit_count()
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = len(self.values) - 1
            at = down

    def within(self, value: int, radius: int) -> list[int]:
        """Members at ``radius`` or fewer differing bits."""
        found, stack = [], [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(values[at])
            edges = children[at]
            if edges:
                stack += [edges[k] for k in range(d - radius, d + radius + 1) if k in edges]
        return found


def _shard_cols(blocks: int, max_bits: int) -> F.Column:
    """Array of shard keys: a hash of (choice of blocks, their bits)."""
    edges = [round(64 * b / blocks) for b in range(blocks + 1)]
    masks = [((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in range(blocks)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(
        int(np.bitwise_or.reduce(np.array([signed[b] for b in chosen], np.int64))))).alias("bits"))
        for i, chosen in enumerate(combinations(range(blocks), blocks - max_bits))])


def link_forest(classes: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None,
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b) edges over distinct ``fp`` that join exactly the components of
    the graph of pairs within ``max_bits``."""
    filed = classes.select("fp", F.explode(_shard_cols(blocks or max_bits + 1, max_bits)).alias("shard"))
    dealt = deal_cells(filed, "shard", "fp", cell_rows, GROUP_ROWS)

    def run(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        shard = group.column("shard").combine_chunks()
        keys = (shard.field("choice").to_numpy(), shard.field("bits").to_numpy(),
                group.column("row").to_numpy(), group.column("col").to_numpy())
        part = group.column("part").to_numpy()
        order = np.lexsort((fps, part, *keys[::-1]))
        cuts = np.flatnonzero(np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)) + 1
        forest = Forest()
        for cell in np.split(order, cuts):
            if len(cell) < 2:
                continue
            values, parts, alone = fps[cell].tolist(), part[cell].tolist(), keys[2][cell[0]] == keys[3][cell[0]]
            tree, first = BKTree(), parts[0]
            for value, p in zip(values, parts):
                if alone or p != first:
                    for other in tree.within(value, max_bits):
                        forest.link(value, other)
                if alone or p == first:
                    tree.add(value)
        edges = np.array(forest.edges(), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": edges[:, 0], "b": edges[:, 1]})

    return dealt.groupBy("group").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = HASH_SEED,
                    blocks: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, kept."""
    marked = materialize(fingerprints(documents, shingle, seed), "simhash-prints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-classes")
    edges = materialize(link_forest(classes, max_bits, blocks, cell_rows), "simhash-links")
    labels = materialize(component_labels(edges, "a", "b"), "simhash-labels")
    member = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp"))
    member = materialize(member, "simhash-members")
    smallest = materialize(member.groupBy("label").agg(F.min("doc_id").alias("component_id")), "simhash-smallest")
    component = materialize(member.select("fp", "label").join(smallest, "label").select("fp", "component_id"),
                            "simhash-components")
    return (marked.join(component, "fp")
                  .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                          F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
