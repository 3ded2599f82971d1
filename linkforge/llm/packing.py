"""Packing (operator 9): first-fit decreasing over a tournament tree of bin
capacities, run independently in randomised groups.

Each document's token ids (plus one end id) are cut into pieces of
``capacity``; the remainder is its last piece. The text is tokenised once,
inside the scan's tasks, and only narrow piece rows (no ids) go on, as a
written table. A seeded hash of the piece deals the pieces into random groups
of about ``group_pieces``; each group is packed by itself. Items are placed
longest first, each into the first bin with room, found by walking down a
tree whose inner nodes hold the largest free capacity below them.

``sequence_id`` = group << 24 | bin, ``offset`` counts from 0 without gaps.

Edge cases: null text counts as empty; an empty document is its end id alone.
Repeated rows are packed each. An empty table gives no rows. A very long text
gives many full pieces, each a sequence of its own. A group holds about
``group_pieces`` rows whatever the size of the input (the number of groups
follows the number of pieces), and identical rows, which hash alike, are told
apart by their position in the scan, so no group can be hot.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokenizing import END_ID, byte_bpe

CAPACITY = 2048
GROUP_PIECES = 8192
SEED = 42
_BIN_BITS = 24

PIECE_TYPES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class TournamentTree:
    """Largest free capacity over bins 0..n-1; leftmost bin with room."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> int:
        tree, i = self.tree, 1
        while i < self.leaves:
            i *= 2
            if tree[i] < length:
                i += 1
        tree[i] -= length
        found, up = i - self.leaves, i // 2
        while up:
            best = max(tree[2 * up], tree[2 * up + 1])
            if tree[up] == best:
                break
            tree[up] = best
            up //= 2
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; items in the order of the array on ties."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int((lengths >= capacity).sum())
    bins[order[:full]] = np.arange(full)
    tree = TournamentTree(max(1, len(lengths) - full), capacity)
    used: dict[int, int] = {}
    for i, n in zip(order[full:].tolist(), lengths[order[full:]].tolist()):
        b = tree.place(n)
        bins[i], offsets[i] = full + b, used.get(b, 0)
        used[b] = used.get(b, 0) + n
    return bins, offsets


def cut_pieces(documents: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID,
               capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens: one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer_path)
        end = np.array([end_id], "<u4")
        for batch in batches:
            row, starts, lengths, sums, totals = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                for s in range(0, len(ids), capacity):
                    piece = ids[s:s + capacity]
                    row.append(k)
                    starts.append(s)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens"])

    narrow = documents.select(id_col, text_col)
    kind = narrow.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, {PIECE_TYPES}")


def pack(documents: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES, seed: int = SEED, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """cut_pieces' columns with sequence_id and offset."""
    pieces = materialize(cut_pieces(documents, tokenizer_path, end_id, capacity, id_col, text_col)
                         .withColumn("scan_pos", F.monotonically_increasing_id()), "pack-pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    dealt = pieces.withColumn("group", F.pmod(
        F.xxhash64(F.lit(seed), id_col, "start", "ids_crc32", "scan_pos"), F.lit(groups)).cast("long"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("scan_pos")
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        ids = (group.column("group").to_numpy() << _BIN_BITS) | bins
        return (group.drop_columns(["scan_pos", "group"])
                     .append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets)))

    kind = pieces.schema[id_col].dataType.simpleString()
    return dealt.groupBy("group").applyInArrow(
        run, f"`{id_col}` {kind}, {PIECE_TYPES}, sequence_id bigint, offset bigint")
