"""Phrase collocation mining (operator 13): top-order marginalisation.

Texts are cut into pieces and words; from each word on, the next words of its
piece are lead columns, padded where the piece ends. Only these longest windows
are counted. Counts of shorter phrases are sums over them: Spark's ROLLUP of
(w1, w2, w3, w4) gives those of all prefixes, and every contiguous phrase is
the prefix of the window at its first word. So no n-gram but the longest is
ever written out.

Everything is per language (null: ``und``). A phrase of 2 to 4 words is a
candidate if it occurs at least ``min_count`` times. Of the cuts of a candidate
into two parts the one of least floor(2000000 * a / (l + r)) scores it (the
first on ties). Candidates inside a longer one that occurs at least 80 % as
often go; each language's ``top`` best stay.

What keeps the windows small, with exact results at every size:

* A word that occurs less often than ``min_count`` is in no candidate and in no
  part of one. Windows end before such words.
* Words are written as numbers: dense ones for the most frequent words, of
  which there are at most ``dictionary_words`` (they go to every task), else a
  63-bit hash. Where all frequent words are in the dictionary, the others are
  known to be rare; where not, words outside it keep their hash and no window
  ends early for them. With a million hashed words two agree with a
  probability of 10^12 / 2^64, 5 * 10^-8.
* Tasks sum equal windows of some megabytes of text before they shuffle them.
  A window common to all rows is one row for each such buffer.
* Windows are dealt out by their first two words, so that a task can sum the
  counts of its pairs and triples and cut windows behind those that occur less
  often than ``min_count`` before the rollup. No pair is more frequent than the
  rarer of its words; where that is more than a task should hold, the pair's
  windows are dealt into shares by their other words and left to the rollup,
  which sums them map-side.

Ranks are taken in two steps, so that no task sorts all phrases of a language.

Edge cases: null text is an empty one. Empty texts and tables give no rows.
Repeated rows count each. Very long texts are read in slices that overlap by
three words. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import broadcast_if_small

MIN_COUNT = 30
TOP = 2000
ORDER = 4
CONTAINED_PERCENT = 80
SCALE = 2_000_000
DICTIONARY_WORDS = 1 << 18
BUFFER_BYTES = 8 << 20
WINDOWS_PER_PARTITION = 2_000_000
W = [f"w{i + 1}" for i in range(ORDER)]

# What ends a piece, and what ends a word within one.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(BREAKS)] = 2
_END = re.compile(b"[" + re.escape(BREAKS + SPACES) + b"]")
_AHEAD = re.compile(b"(?:[ \t]+[^" + re.escape(BREAKS + SPACES) + b"]+){0,%d}" % (ORDER - 1))
_HASH_BITS = 62


def _slices(text: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """(slice, how many of its bytes hold first words); cut between words, with
    the words that windows begun before the cut still need."""
    at = 0
    while len(text) - at > limit and (end := _END.search(text, at + limit)):
        cut = end.start()
        yield text[at:_AHEAD.match(text, cut).end()], cut - at
        at = cut
    yield text[at:], len(text) - at


def _buffers(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, bytes, int]]:
    """(language, texts, bytes with first words): texts of one language joined
    by line ends, some ``limit`` bytes of all languages at a time."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0

    def told() -> Iterator[tuple[str, bytes, int]]:
        for lang, texts in held.items():
            joined = b"\n".join(texts)
            yield lang, joined, len(joined)
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, value in zip(langs, batch.column(1)):
            text = value.as_buffer().to_pybytes()
            if len(text) > limit:
                yield from ((lang, *part) for part in _slices(text, limit))
                continue
            held[lang].append(text)
            size += len(text)
            if size >= limit:
                yield from told()
                size = 0
    yield from told()


def _tokens(data: bytes, first_bytes: int) -> tuple[pa.DictionaryArray, np.ndarray, int]:
    """Words, the piece of each, and how many begin in ``first_bytes``."""
    chars = _LOWER[np.frombuffer(data, np.uint8)]
    kinds = _KIND[chars]
    inside = np.zeros(len(chars) + 2, np.int8)
    inside[1:-1] = kinds == 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(chars[kinds == 0])])
    pieces = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    return words.dictionary_encode(), pieces, int(np.searchsorted(starts, first_bytes))


def count_words(batches: Iterator[pa.RecordBatch], limit: int = BUFFER_BYTES) -> Iterator[pa.RecordBatch]:
    """lang, word, n of each buffer."""
    for lang, data, first_bytes in _buffers(batches, limit):
        words, _, first = _tokens(data, first_bytes)
        counts = np.bincount(words.indices.to_numpy()[:first], minlength=len(words.dictionary))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), words.dictionary.take(pa.array(used)),
                                          pa.array(counts[used], pa.int64())], names=["lang", "word", "n"])


def _named(lang: str, words: pa.Array, known: dict[str, tuple[pa.Array, np.ndarray]], complete: bool) -> np.ndarray:
    """Number of each word; 0 for those known to be rare."""
    listed, ids = known.get(lang, (pa.array([], pa.string()), np.zeros(0, np.int64)))
    place = pc.fill_null(pc.index_in(words, value_set=listed), -1).to_numpy(zero_copy_only=False)
    named = np.where(place >= 0, np.append(ids, 0)[place], 0)
    if not complete:
        for i in np.flatnonzero(place < 0).tolist():
            named[i] = word_hash(lang, words[i].as_py())
    return named


def word_hash(lang: str, word: str) -> int:
    return -1 - (xxhash.xxh64_intdigest(f"{lang}\0{word}".encode(), seed=42) & ((1 << _HASH_BITS) - 1))


def _word_hash(lang: str, word: str) -> Column:
    """word_hash as a column."""
    h = F.xxhash64(F.concat(F.col(lang), F.lit("\0"), F.col(word)))
    return -1 - h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1))


def _shares(windows: np.ndarray, most: np.ndarray, per_task: int) -> np.ndarray:
    """0, or from 1 on the share of a pair that may have more than ``per_task``
    windows; ``most`` bounds the counts of each window's first two words."""
    shares = -(-most.min(axis=0) // per_task)
    mixed = windows[2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ windows[3].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    share = ((mixed >> np.uint64(20)) % np.maximum(shares, 1).astype(np.uint64)).astype(np.int64) + 1
    return np.where((shares > 1) & (windows[1] != 0), share, 0)


def _lead_windows(ids: np.ndarray, pieces: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows (columns of word numbers, 0 for padding) and counts."""
    lead = np.zeros((ORDER, len(ids)), np.int64)
    lead[0] = ids
    for k in range(1, ORDER):
        n = len(ids) - k
        if n > 0:
            here = (pieces[k:] == pieces[:n]) & (lead[k - 1][:n] != 0)
            lead[k][:n] = np.where(here, ids[k:], 0)
    lead = lead[:, :first]
    lead = lead[:, lead[0] != 0]
    if not lead.shape[1]:
        return lead, np.zeros(0, np.int64)
    order = np.lexsort(lead[::-1])
    lead = lead[:, order]
    new = np.flatnonzero(np.append(True, (lead[:, 1:] != lead[:, :-1]).any(axis=0)))
    return lead[:, new], np.diff(np.append(new, lead.shape[1]))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def frequent_words(docs: DataFrame, min_count: int, dictionary_words: int, lang_col: str = "lang", text_col: str = "text",
                   buffer_bytes: int = BUFFER_BYTES) -> tuple[DataFrame, DataFrame, bool]:
    """(lang, word, f, id) of the words that occur ``min_count`` times, n of
    each language, and whether all of them have dictionary numbers (id > 0)."""
    spark = docs.sparkSession
    counted = _texts(docs, lang_col, text_col).mapInArrow(partial(count_words, limit=buffer_bytes), "lang string, word string, n bigint")
    words = materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "collocation-words")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "collocation-totals")
    frequent = words.where(F.col("f") >= min_count).withColumn("bits", F.length(F.bin("f")))
    # How many words have f of so many binary digits: one row for each length.
    held, least = 0, 65
    for row in sorted(frequent.groupBy("bits").count().collect(), reverse=True):
        if held + row["count"] > dictionary_words:
            break
        held, least = held + row["count"], row["bits"]
    known = frequent.where(F.col("bits") >= least)
    others = frequent.where(F.col("bits") < least)
    dense = (known.coalesce(1).sortWithinPartitions(F.desc("f"), "lang", "word")
                  .select("lang", "word", "f", (F.monotonically_increasing_id() + 1).alias("id")))
    hashed = others.select("lang", "word", "f", _word_hash("lang", "word").alias("id"))
    named = materialize(dense.unionByName(hashed), "collocation-vocabulary")
    return named, totals, others.isEmpty()


def _dictionary(named: DataFrame) -> tuple[dict[str, tuple[pa.Array, np.ndarray]], np.ndarray]:
    """Words and numbers by language, and the count of each number (of 0: of the
    rarest, which bounds those of hashed words); bounded by ``dictionary_words``."""
    table = named.where("id > 0").select("lang", "word", "id", "f").toArrow().combine_chunks()
    out = {}
    for lang in table.column("lang").unique().to_pylist():
        rows = table.filter(pc.equal(table.column("lang"), lang))
        out[lang] = (pa.array(rows.column("word").to_pylist(), pa.string()), rows.column("id").to_numpy())
    counts = np.zeros(len(table) + 1, np.int64)
    counts[table.column("id").to_numpy()] = table.column("f").to_numpy()
    counts[0] = counts[1:].min() if len(table) else np.iinfo(np.int64).max
    return out, counts


def longest_windows(docs: DataFrame, named: DataFrame, complete: bool, partitions: int, per_task: int = WINDOWS_PER_PARTITION,
                    lang_col: str = "lang", text_col: str = "text", buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """w1 .. w4, share, n: windows of word numbers, padded with 0, and their
    counts; a partition holds all windows of its pairs and shares."""
    shared = docs.sparkSession.sparkContext.broadcast(_dictionary(named))
    columns = [*W, "share", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, f = shared.value
        for lang, data, first_bytes in _buffers(batches, buffer_bytes):
            words, pieces, first = _tokens(data, first_bytes)
            ids = _named(lang, words.dictionary, known, complete)[words.indices.to_numpy()]
            windows, counts = _lead_windows(ids, pieces, first)
            share = _shares(windows, f[np.maximum(windows[:2], 0)], per_task)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*windows, share, counts)], names=columns)

    counted = _texts(docs, lang_col, text_col).mapInArrow(run, ", ".join(f"{c} bigint" for c in columns))
    # Rows are summed already, so they are dealt out before Spark sums them.
    return counted.repartition(partitions, "w1", "w2", "share").groupBy("w1", "w2", "share", "w3", "w4").agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, min_count: int) -> DataFrame:
    """w1 .. w4 (0 past the end), size, f of the phrases of 2 words and more
    that occur ``min_count`` times."""
    pair = ["w1", "w2", "share"]
    whole = F.col("share") == 0
    # Filtered between the two sums, so that the second sorts fewer rows.
    told = windows.where("w2 <> 0").withColumn("of_two", F.sum("n").over(Window.partitionBy(*pair)))
    frequent = (told.where(~whole | (F.col("of_two") >= min_count))
                    .withColumn("of_three", F.sum("n").over(Window.partitionBy(*pair, "w3"))))
    cut = frequent.select("w1", "w2", F.when(~whole | (F.col("of_three") >= min_count), F.col("w3")).otherwise(0).alias("w3"),
                          F.when(F.col("n") >= min_count, F.col("w4")).otherwise(0).alias("w4"), "n")
    summed = cut.rollup(*W).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    size = ORDER - F.length(F.bin("left_out")) + F.when(F.col("left_out") == 0, 1).otherwise(0)
    sized = summed.withColumn("size", size).where((F.col("f") >= min_count) & (F.col("size") >= 2))
    # A phrase that ends in padding is a shorter one, summed on its own.
    return (sized.where(F.array(*W)[F.col("size") - 1] != 0)
                 .select(*(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in W), "size", "f"))


def _part_of(words: Column, start: Column, size: Column) -> list[Column]:
    """w1 .. w4 of ``size`` words from ``start`` (from 1) of an array."""
    part = F.slice(words, start, size)
    return [F.coalesce(F.get(part, F.lit(i)), F.lit(0)) for i in range(ORDER)]


def _joined(rows: DataFrame, counts: DataFrame, n: int, words: list[Column], name: str) -> DataFrame:
    """``rows`` with the count of the phrase that ``words`` name."""
    keyed = rows.select("*", *(w.alias(f"key{i}") for i, w in enumerate(words)))
    told = counts.select(*(F.col(c).alias(f"key{i}") for i, c in enumerate(W)), F.col("f").alias(name))
    keys = [f"key{i}" for i in range(ORDER)]
    return keyed.join(broadcast_if_small(told, n, 64), keys).drop(*keys)


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of their lowest cut."""
    single = words.select(F.col("id").alias("w1"), *(F.lit(0).cast("long").alias(c) for c in W[1:]), "f")
    counts = phrases.select(*W, "f").unionByName(single)
    n = counts.count()
    cuts = phrases.withColumn("words", F.array(*W)).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = _joined(cuts, counts, n, _part_of(F.col("words"), F.lit(1), F.col("k")), "l")
    both = _joined(left, counts, n, _part_of(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")), "r")
    # 38 decimal digits hold the product of any two counts.
    score = F.expr(f"CAST(f AS DECIMAL(20, 0)) * {SCALE} DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    return both.groupBy(*W, "size", "f").agg(lowest).select(*W, "size", "f", "lowest.l", "lowest.r", "lowest.score")


def not_contained(phrases: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Without phrases inside a longer one that is ``percent`` as frequent."""
    places = [(i, n) for n in range(2, ORDER) for i in range(1, ORDER - n + 2)]
    inner = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in places))
    longer = phrases.select("size", F.col("f").alias("around"), F.array(*W).alias("words"), F.explode(inner).alias("at"))
    longer = longer.where("at.n < size AND at.i + at.n - 1 <= size")
    part = _part_of(F.col("words"), F.col("at.i"), F.col("at.n"))
    most = longer.select("around", *(p.alias(c) for p, c in zip(part, W))).groupBy(*W).agg(F.max("around").alias("around"))
    judged = phrases.join(most, W, "left")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    inside = F.coalesce(wide("around") * 100 >= wide("f") * percent, F.lit(False))
    return judged.where(~inside).drop("around")


def _spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """lang and phrase of word numbers."""
    n = words.count()
    for i, c in enumerate(W):
        told = words.select(F.col("id").alias(c), F.col("word").alias(f"word{i}"), *([F.col("lang")] if i == 0 else []))
        phrases = phrases.join(broadcast_if_small(told, n, 48), c, "inner" if i == 0 else "left")
    return phrases.withColumn("phrase", F.concat_ws(" ", *(f"word{i}" for i in range(ORDER))))


def mine_collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, dictionary_words: int = DICTIONARY_WORDS,
                      lang_col: str = "lang", text_col: str = "text", buffer_bytes: int = BUFFER_BYTES,
                      per_task: int = WINDOWS_PER_PARTITION) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score; numbers long."""
    words, totals, complete = frequent_words(docs, min_count, dictionary_words, lang_col, text_col, buffer_bytes)
    n_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    partitions = max(_floor(docs.sparkSession), math.ceil(n_words / per_task))
    windows = longest_windows(docs, words, complete, partitions, per_task, lang_col, text_col, buffer_bytes)
    phrases = materialize(phrase_counts(windows, min_count), "collocation-phrases")
    best = not_contained(materialize(scored(phrases, words), "collocation-scores"))
    spelled = materialize(_spelled(best, words), "collocation-spelled")
    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    shares = max(1, math.ceil(spelled.count() / (50 * top)))
    near = spelled.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    for keys in (["lang", "share"], ["lang"]):
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return near.join(F.broadcast(totals) if totals.count() < 10_000 else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n",
        F.col("score").cast("long").alias("score"))


def _floor(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
