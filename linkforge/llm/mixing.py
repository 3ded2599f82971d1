"""Mixing sources to target weights (operator 8): Sainte-Lague apportionment.

Sizes are words. Each source's target is its weight's share of all words,
stopped at ``max_repeat`` times its size; the excess is shared again by weight
until no target is above its stop. The mix consists of blocks of
``block_words`` words. Seats (blocks) go to the sources one by one by the
highest quotient target / (2k + 1); seats are dealt to output shards in that
order, an equal number to each, so the first n seats are the apportionment of
n seats and every shard has integer quotas that follow the weights.

A source's documents stand in a seeded order (md5 of seed and id) and form
one stream of words, cut into M equal blocks (the last may be shorter). A
source with q seats takes its blocks in rounds: copy c of block k is seat
c * M + pi(k), taken when that is below q, where pi is a seeded permutation of
the blocks. So every block is taken floor(q / M) or one more times, never more
than ``max_repeat``, and exactly q block copies are taken.

``mix`` returns one row per document with its taken pieces (first word,
words, block, round, shard); nothing is listed per block. ``mixed_documents``
gives the texts: one row for each round that takes words of a document, whole
or cut to the taken words. Counting words and
the running offsets are Spark jobs: offsets come from two levels, running
sums inside (source, first three hex digits of the md5) and running sums of
those buckets' totals, so no source is ordered in one task. Only the table of
sources, one row per source, is worked on in the driver.

Edge cases: null text has size 0; null is a source of its own, last in order;
documents of size 0 take nothing; an empty table gives an empty result.
Repeated rows each have their own place in the stream; ties in the order are
broken by id, then size. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, broadcast_if_small

BLOCK_WORDS = 32
MAX_REPEAT = 3
SHARDS = 64
SEED = 42
WEIGHTS = (5, 2, 1)

_PLAN_ROW_BYTES = 256
_MOST_BLOCKS = 200_000  # handled at once in a task


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: Sequence[int], weights: Sequence[int], max_repeat: int = MAX_REPEAT) -> list[float]:
    """Weight shares of the total, stopped at max_repeat * size."""
    caps = [max_repeat * s for s in sizes]
    stopped: set[int] = set()
    while True:
        rest = sum(sizes) - sum(caps[i] for i in stopped)
        weight = sum(w for i, w in enumerate(weights) if i not in stopped)
        above = {i for i, w in enumerate(weights) if i not in stopped and caps[i] * weight < rest * w}
        if not above:
            return [float(caps[i]) if i in stopped or not weight else rest / weight * w
                    for i, w in enumerate(weights)]
        stopped |= above


def sainte_lague(votes: Sequence[float], limits: Sequence[int], seats: int) -> list[int]:
    """Seats by highest quotient votes / (2k + 1), at most limits[i] each; a
    tie goes to the earlier one. House monotone: n + 1 seats add one to n."""
    seats = min(seats, sum(limits))

    def above(threshold: float) -> list[int]:
        out = []
        for v, most in zip(votes, limits):
            k = min(most, max(0, math.ceil((v / threshold - 1) / 2) + 1))
            while k and v / (2 * k - 1) < threshold:
                k -= 1
            out.append(k)
        return out

    low, high = 0.0, max([*votes, 0.0]) + 1.0
    for _ in range(200):  # high: a quotient that at most ``seats`` quotients reach
        middle = (low + high) / 2
        if middle <= low or middle >= high:
            break
        if sum(above(middle)) <= seats:
            high = middle
        else:
            low = middle
    got = above(high)
    heap = [(-v / (2 * k + 1), i) for i, (v, k) in enumerate(zip(votes, got)) if k < limits[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < limits[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def _hex(seed: int, source: str | None, digits: slice) -> int:
    name = "null" if source is None else f"s{source}"
    return int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[digits], 16)


def source_plan(totals: Sequence[tuple[str | None, int]], block_words: int = BLOCK_WORDS,
                max_repeat: int = MAX_REPEAT, shards: int = SHARDS, weights: Sequence[int] = WEIGHTS,
                seed: int = SEED) -> list[dict]:
    """One row per source: size, target, blocks, seats, the permutation's
    step and shift, and the seats it holds up to each shard's end."""
    totals = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [n for _, n in totals]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(totals))], max_repeat)
    blocks = [-(-n // block_words) for n in sizes]
    limits = [max_repeat * m for m in blocks]
    total_seats = (2 * sum(sizes) + block_words) // (2 * block_words)
    ends = [sainte_lague(targets, limits, total_seats * (s + 1) // shards) for s in range(shards)]
    plan = []
    for i, (source, size) in enumerate(totals):
        m = max(1, blocks[i])
        step = 1 + _hex(seed, source, slice(0, 5))
        while math.gcd(step, m) != 1:
            step += 1
        plan.append({"plan_id": i, "source": source, "source_size": size, "target": targets[i], "blocks": blocks[i],
                     "seats": ends[-1][i], "step": step, "shift": _hex(seed, source, slice(5, 10)) % m,
                     "shard_ends": [e[i] for e in ends]})
    return plan


PLAN_TYPES = ("plan_id bigint, source string, source_size bigint, target double, blocks bigint, seats bigint, step bigint, "
              "shift bigint, shard_ends array<bigint>")


def _placed(sized: DataFrame) -> DataFrame:
    """Adds ``first``: the words of the source before the document."""
    inside = Window.partitionBy("source", "bucket").orderBy("spot", F.col("doc_id").asc_nulls_last(), "size")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
                    .select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")))
    inner = sized.withColumn("ahead", F.coalesce(
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same = inner["source"].eqNullSafe(buckets["source"]) & (inner["bucket"] == buckets["bucket"])
    return (inner.join(buckets, same)
                 .select(*(inner[c] for c in sized.columns), (F.col("base") + F.col("ahead")).alias("first")))


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS, max_repeat: int = MAX_REPEAT, shards: int = SHARDS,
        weights: Sequence[int] = WEIGHTS, seed: int = SEED, key_cols: Sequence[str] = ()) -> DataFrame:
    """doc_id, [key_cols,] size, source, source_size, target, taken and pieces
    (start, words, block, round, shard; start counts the document's words)."""
    spark = documents.sparkSession
    spot = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = materialize(
        documents.select("doc_id", *key_cols, "source", word_count(F.col("text")).alias("size"), spot.alias("spot"))
                 .withColumn("bucket", F.substring("spot", 1, 3)), "mix-sizes")
    totals = [(r["source"], r["words"]) for r in
              sized.groupBy("source").agg(F.sum("size").alias("words")).collect()]
    plan = spark.createDataFrame(source_plan(totals, block_words, max_repeat, shards, weights, seed), PLAN_TYPES)
    plan = broadcast_if_small(plan.withColumnRenamed("source", "plan_source"), len(totals), _PLAN_ROW_BYTES + 8 * shards)
    placed = _placed(sized).join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    keep = ["doc_id", *key_cols, "size", "source", "source_size", "target"]
    work = ["first", "blocks", "seats", "step", "shift", "plan_id", "shard_ends"]
    rows = placed.select(F.struct(*keep).alias("row"), "size", *work)
    task = partial(_pieces_task, block_words=block_words, max_repeat=max_repeat)
    return rows.mapInArrow(task, f"row {rows.schema['row'].dataType.simpleString()}, taken bigint, {PIECE_TYPES}").select(
        "row.*", "taken", "pieces")


PIECE_TYPES = "pieces array<struct<start:bigint,words:bigint,block:bigint,round:int,shard:int,seat:bigint>>"


def _short_batches(batches: Iterator[pa.RecordBatch], most_words: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of about ``most_words`` words, a row at least."""
    for batch in batches:
        reached = np.cumsum(batch.column("size").to_numpy())
        at = 0
        while at < batch.num_rows:
            before = reached[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(reached, before + most_words, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _pieces_task(batches: Iterator[pa.RecordBatch], block_words: int, max_repeat: int) -> Iterator[pa.RecordBatch]:
    """The taken block copies of each document."""
    for batch in _short_batches(batches, block_words * _MOST_BLOCKS):
        size, first, blocks, seats, step, shift, plan = (
            batch.column(c).to_numpy() for c in ("size", "first", "blocks", "seats", "step", "shift", "plan_id"))
        low = first // block_words
        count = np.where(size > 0, (first + size - 1) // block_words - low + 1, 0) * max_repeat
        doc = np.repeat(np.arange(len(size)), count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        block, turn = low[doc] + nth // max_repeat, nth % max_repeat
        seat = turn * blocks[doc] + (step[doc] * block + shift[doc]) % np.maximum(blocks[doc], 1)
        taken = seat < seats[doc]
        doc, block, turn, seat = doc[taken], block[taken], turn[taken], seat[taken]
        start = np.maximum(block * block_words, first[doc])
        words = np.minimum((block + 1) * block_words, first[doc] + size[doc]) - start
        shard = np.zeros(len(doc), np.int64)
        for p, row in zip(*np.unique(plan, return_index=True)):
            of_plan = plan[doc] == p
            shard[of_plan] = np.searchsorted(np.array(batch.column("shard_ends")[int(row)].as_py()), seat[of_plan], "right")
        fields = {"start": start - first[doc], "words": words, "block": block, "round": turn.astype(np.int32),
                  "shard": shard.astype(np.int32), "seat": seat}
        offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(size)))]).astype(np.int32)
        pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
            [pa.array(v) for v in fields.values()], names=list(fields)))
        total = np.bincount(doc, words, len(size)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(total), pieces], names=["row", "taken", "pieces"])


def shard_quotas(mixed: DataFrame) -> DataFrame:
    """Words by shard and source of a mix."""
    return (mixed.select("source", F.explode("pieces").alias("p"))
                 .groupBy("source", F.col("p.shard").alias("shard")).agg(F.sum("p.words").alias("words")))


_WORD = re.compile(WORD)


_CUT_BYTES = 4 << 20  # texts and runs of a batch worked on at a time


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that texts (column 1) and lists (column 2) of a slice
    have about ``_CUT_BYTES``; a row at least."""
    for batch in batches:
        text = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        runs = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        reached, at = np.cumsum(text + 20 * runs), 0
        while at < batch.num_rows:
            before = reached[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(reached, before + _CUT_BYTES, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _runs_by_round(pieces: pa.StructArray) -> list[list[tuple[int, int]]]:
    """(first word, words) of each round's pieces, neighbours joined, rounds
    in order."""
    turn, start, words = (pieces.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    order = np.lexsort((start, turn))
    turn, start, words = turn[order], start[order], words[order]
    new = np.flatnonzero(np.append(True, (turn[1:] != turn[:-1]) | (start[1:] != start[:-1] + words[:-1])))
    total = np.add.reduceat(words, new)
    runs: list[list[tuple[int, int]]] = []
    for i, t, a, n in zip(range(len(new)), turn[new].tolist(), start[new].tolist(), total.tolist()):
        if i == 0 or t != last:
            runs.append([])
        runs[-1].append((a, n))
        last = t
    return runs


def cut_words(text: str, runs: Sequence[tuple[int, int]]) -> str:
    """The text if ``runs`` (first word, words; ascending) cover it, else the
    stretches of text that they cover, on a line each."""
    merged: list[list[int]] = []
    for start, n in runs:
        if merged and merged[-1][1] == start:
            merged[-1][1] += n
        else:
            merged.append([start, start + n])
    spans = [m.span() for m in _WORD.finditer(text)]
    if merged == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in merged)


def mixed_documents(documents: DataFrame, block_words: int = BLOCK_WORDS, max_repeat: int = MAX_REPEAT, shards: int = SHARDS,
                    weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix as rows with the columns of ``documents``: text cut to the words
    taken in one round, ``n_chars`` (if there) its length.

    Rows are told apart by their place in the scan, so repeated rows and ids
    each keep their own pieces; ``documents`` must therefore be a stored table
    (a scan), which gives a row the same place each time it is read."""
    others = [c for c in documents.columns if c not in ("text", "n_chars")]
    placed = documents.select(F.monotonically_increasing_id().alias("mix_row"), "doc_id", "source", "text",
                              F.struct(*others).alias("row"))
    mixed = mix(placed, block_words, max_repeat, shards, weights, seed, key_cols=["mix_row"])
    taken = mixed.where("taken > 0").select(F.col("mix_row").alias("row_taken"), F.transform("pieces", lambda p: F.struct(
        p["round"].alias("round"), p["start"].alias("start"), p["words"].alias("words"))).alias("pieces"))
    rows = placed.join(taken, F.col("mix_row") == F.col("row_taken")).select("row", "text", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small_batches(batches):
            at, texts = [], []
            for k, (text, pieces) in enumerate(zip(batch.column(1), batch.column(2))):
                text = text.as_py()
                for runs in _runs_by_round(pieces.values):
                    at.append(k)
                    texts.append(cut_words(text, runs))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(texts, pa.string())],
                                             names=["row", "text"])

    cut = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string").select("row.*", "text")
    if "n_chars" in documents.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return cut.select(*documents.columns)
