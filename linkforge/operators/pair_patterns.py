"""Agreement-pattern counts of all candidate pairs without a row for any pair.

The sufficient statistics of EM are counts of comparison vectors. The rows of a
block (or of a cell of a hot block, see ``blocking``) come to a task sorted by
id, values become codes, and the vectors of a tile of pairs are made at once as
numbers: a bit for each column that is equal, the level of each similarity, and
which values are missing; a histogram of these numbers is all that is kept.
Every pair is compared, in a few nanoseconds and within a tile's memory;
shuffled are the records of the blocks, returned are patterns.

Which rule a pair matches first follows from the equal columns, which the
number holds; so patterns of other rules' pairs are dropped when the histogram
is read, not pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jaro import BOOST_THRESHOLD, MAX_PREFIX, PREFIX_SCALE, _distinct_scores
from ..session import work_partitions
from ..settings import LinkSettings
from . import blocking

# A block with more rows than this is counted in cells of so many rows a side.
CELL_ROWS = 16_384
# Pairs for each task, and pairs compared at once.
PAIRS_PER_TASK = 64_000_000
TILE_PAIRS = 1_000_000
# Groups up to this size are compared together, as lists of pairs.
SMALL_GROUP = 24
# String pairs scored at once, and kept levels of a cell.
SCORED_AT_ONCE = 200_000
KEPT_LEVELS = 32_000_000
# Histograms up to this size are arrays.
MOST_BINS = 4_000_000
_BOUND_SLACK = 1e-9


@dataclass(frozen=True)
class _Layout:
    """Places of the columns in a pattern's number:
    (missing mask * levels + level) << bits | equal bits."""

    equal: tuple[str, ...]                 # columns with a bit: exact comparisons, then other rule columns
    exact: int                             # how many of them are comparisons
    fuzzy: tuple[tuple[str, tuple[float, ...], int], ...]  # column, thresholds, exact level
    rules: tuple[tuple[str, ...], ...]
    gammas: tuple[tuple[str, str, int], ...]               # gamma column, compared column, exact level

    @property
    def levels(self) -> int:
        return math.prod(top + 2 for _, _, top in self.fuzzy)  # missing, 0, ..., exact

    def columns(self) -> list[str]:
        return [*self.equal, *[c for c, _, _ in self.fuzzy]]


def _layout(settings: LinkSettings, rules) -> _Layout:
    fuzzy = tuple((c.column, tuple(c.thresholds), c.exact_level) for c in settings.comparisons if c.kind == "jaro_winkler")
    exact = [c.column for c in settings.comparisons if c.kind != "jaro_winkler"]
    known = {*exact, *[f[0] for f in fuzzy]}
    others = [k for k in dict.fromkeys(k for rule in rules for k in rule) if k not in known]
    return _Layout((*exact, *others), len(exact), fuzzy, tuple(map(tuple, rules)),
                   tuple((c.gamma, c.column, c.exact_level) for c in settings.comparisons))


class _Strings:
    """The distinct strings of a column in a table and the levels of their pairs."""

    def __init__(self, values: list[str], thresholds: tuple[float, ...], exact: int):
        self.values, self.thresholds, self.exact = values, thresholds, exact
        self.bytes = np.array([len(v.encode("utf-8")) for v in values], dtype=np.float64)

    def levels(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the level (0 for missing) of each pair of codes."""
        out = np.ones(len(a), dtype=np.uint8)
        out[(a < 0) | (b < 0)] = 0
        equal = (a == b) & (a >= 0)
        out[equal] = self.exact + 1
        at = np.flatnonzero((out == 1) & ~equal)
        la, lb = self.bytes[a[at]], self.bytes[b[at]]
        bound = (np.minimum(la, lb) / np.maximum(la, lb) + 2.0) / 3.0
        bound = np.where(bound > BOOST_THRESHOLD, bound + PREFIX_SCALE * MAX_PREFIX * (1 - bound), bound)
        at = at[bound + _BOUND_SLACK >= min(self.thresholds)]
        for start in range(0, len(at), SCORED_AT_ONCE):
            some = at[start:start + SCORED_AT_ONCE]
            scores = _distinct_scores([(self.values[x], self.values[y]) for x, y in zip(a[some].tolist(), b[some].tolist())])
            level = np.zeros(len(some), dtype=np.uint8)
            for place, t in reversed(list(zip(range(self.exact - 1, 0, -1), self.thresholds))):
                level[scores >= t] = place
            out[some] = level + 1
        return out


class _Rows:
    """Coded rows of whole groups, each sorted by id."""

    def __init__(self, table: pa.Table, layout: _Layout):
        def coded(name):
            column = table.column(name).combine_chunks()
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            return column.dictionary_encode()
        self.layout, n = layout, table.num_rows
        self.missing = np.zeros(n, dtype=np.int64)
        self.equal = []
        for i, c in enumerate(layout.equal):
            codes = coded(c).indices.fill_null(-1).to_numpy()
            if i < layout.exact:
                self.missing |= (codes < 0).astype(np.int64) << i
            self.equal.append(codes.astype(np.int16) if n < 32_000 else codes.astype(np.int32))
        self.fuzzy, self.strings = [], []
        for c, thresholds, exact in layout.fuzzy:
            codes = coded(c)
            self.fuzzy.append(codes.indices.fill_null(-1).to_numpy().astype(np.int64))
            self.strings.append(_Strings(codes.dictionary.to_pylist(), thresholds, exact))
        # Numbers that rise with the ids of a group; codes rise with first mention only.
        ids = coded("_id").indices.to_numpy()
        self.ids = np.cumsum(np.append(0, ids[1:] != ids[:-1])) if n else ids
        self.copies = table.column("_copies").to_numpy()
        self.part = table.column("_part").to_numpy()


class _Counter:
    """Counts of the numbers of one rule's pairs."""

    def __init__(self, layout: _Layout):
        self.layout, self.bits = layout, len(layout.equal)
        self.counts: dict[int, int] = {}

    def _add(self, numbers: np.ndarray, counts: np.ndarray) -> None:
        known = self.counts
        for number, n in zip(numbers.tolist(), counts.tolist()):
            known[number] = known.get(number, 0) + n

    def pairs(self, rows: _Rows, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs given by the places of their rows."""
        numbers = rows.missing[a] | rows.missing[b]
        for codes, strings in zip(rows.fuzzy, rows.strings):
            both, where = np.unique((codes[a] + 1) * (len(strings.values) + 1) + codes[b] + 1, return_inverse=True)
            x, y = np.divmod(both, len(strings.values) + 1)
            numbers = numbers * (strings.exact + 2) + strings.levels(x - 1, y - 1)[where]
        numbers <<= self.bits
        for i, codes in enumerate(rows.equal):
            numbers |= ((codes[a] == codes[b]) & (codes[a] >= 0)).astype(np.int64) << i
        found, where = np.unique(numbers, return_inverse=True)
        weights = np.zeros(len(found), dtype=np.int64)
        np.add.at(weights, where, rows.copies[a] * rows.copies[b])
        self._add(found, weights)

    def block(self, rows: _Rows, a: slice, b: slice, within: bool) -> None:
        """All pairs of a row of ``a`` with a row of ``b``; ``within``: they are
        the same rows, and pairs have their ids in order."""
        bits, constant, varying = self.bits, 0, []
        for i, codes in enumerate(rows.equal):
            x, y = codes[a], codes[b]
            if x[0] >= 0 and (x == x[0]).all() and (y == x[0]).all():
                constant |= 1 << i
            elif (x >= 0).any() and (y >= 0).any():
                varying.append((i, x, np.where(y < 0, y.dtype.type(-2), y)))
        masks_a, of_a = np.unique(rows.missing[a], return_inverse=True)
        masks_b, of_b = np.unique(rows.missing[b], return_inverse=True)
        masks, union = np.unique(masks_a[:, None] | masks_b[None, :], return_inverse=True)
        union = union.reshape(len(masks_a), len(masks_b))
        values = []
        for codes, strings in zip(rows.fuzzy, rows.strings):
            left, of_left = np.unique(codes[a], return_inverse=True)
            right, of_right = np.unique(codes[b], return_inverse=True)
            values.append((strings, left, of_left, right, of_right, {}))
        levels, width = self.layout.levels, len(varying)
        bins = len(masks) * levels << width
        counts = np.zeros(bins + 1, dtype=np.int64) if bins <= MOST_BINS else None
        n, m = a.stop - a.start, b.stop - b.start
        weighted = (rows.copies[a] > 1).any() or (rows.copies[b] > 1).any()
        step = max(1, TILE_PAIRS // m)
        for start in range(0, n, step):
            stop = min(n, start + step)
            first = start if within else 0  # rows before have been paired
            kinds = np.stack([of_a[start:stop], *[v[2][start:stop] for v in values]], axis=1)
            kinds, kind_of = np.unique(kinds, axis=0, return_inverse=True)
            base = union[kinds[:, 0]][:, of_b[first:]].astype(np.int64)
            for at, (strings, left, _, right, of_right, kept) in enumerate(values):
                wanted = kinds[:, at + 1]
                new = [k for k in dict.fromkeys(wanted.tolist()) if k not in kept]
                if new:
                    if len(kept) * len(right) > KEPT_LEVELS:
                        kept.clear()
                        new = list(dict.fromkeys(wanted.tolist()))
                    found = strings.levels(np.repeat(left[new], len(right)), np.tile(right, len(new)))
                    kept.update(zip(new, found.reshape(len(new), len(right))))
                base *= strings.exact + 2
                base += np.stack([kept[k] for k in wanted.tolist()])[:, of_right[first:]]
            base <<= width
            numbers = base[kind_of.reshape(-1)]
            for low in range(0, width, 8):
                plane = np.zeros(numbers.shape, dtype=np.uint8)
                for bit, (_, x, y) in enumerate(varying[low:low + 8]):
                    same = np.equal(x[start:stop, None], y[None, first:]).view(np.uint8)
                    if bit:
                        same = np.left_shift(same, np.uint8(bit), out=same)
                    plane |= same
                numbers |= plane.astype(np.int64) << low if low else plane
            weights = (rows.copies[a][start:stop, None] * rows.copies[b][None, first:]) if weighted else None
            if within:
                ids = rows.ids[a][start:stop], rows.ids[b][first:]
                reached = int(np.searchsorted(rows.ids[b][first:], ids[0][-1], side="right"))
                numbers[:, :reached][ids[1][None, :reached] <= ids[0][:, None]] = bins
            if counts is not None:
                flat = weights.ravel().astype(np.float64) if weighted else None
                tile = np.bincount(numbers.ravel(), weights=flat, minlength=bins + 1)
                counts += np.rint(tile).astype(np.int64) if weighted else tile
            else:
                found, where = np.unique(numbers, return_inverse=True)
                sums = np.zeros(len(found), dtype=np.int64)
                np.add.at(sums, where.ravel(), weights.ravel() if weighted else 1)
                inside = found < bins
                self._expand(found[inside], sums[inside], masks, levels, varying, constant)
        if counts is not None:
            found = np.flatnonzero(counts[:bins])
            self._expand(found, counts[found], masks, levels, varying, constant)

    def _expand(self, found, counts, masks, levels, varying, constant) -> None:
        width = len(varying)
        head, low = found >> width, found & ((1 << width) - 1)
        full = np.full(len(found), constant, dtype=np.int64)
        for bit, (i, _, _) in enumerate(varying):
            full |= (low >> bit & 1) << i
        self._add((masks[head // levels] * levels + head % levels) << self.bits | full, counts)

    def patterns(self, rule: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """(gammas, pairs) of the pairs whose first match is the rule."""
        layout = self.layout
        for number, n in self.counts.items():
            head, equal = number >> self.bits, number & ((1 << self.bits) - 1)
            mask, level = divmod(head, layout.levels)
            same = {c: equal >> i & 1 == 1 for i, c in enumerate(layout.equal)}
            place = {}
            for c, _, top in reversed(layout.fuzzy):
                level, place[c] = divmod(level, top + 2)
                same[c] = place[c] == top + 1
            matched = [all(same[k] for k in r) for r in layout.rules[:rule + 1]]
            if not matched[rule] or any(matched[:rule]):
                continue
            yield tuple(place[c] - 1 if c in place else -1 if mask >> layout.equal.index(c) & 1
                        else top if same[c] else 0 for _, c, top in layout.gammas), n


def _changes(table: pa.Table) -> np.ndarray:
    """Where groups begin."""
    n = table.num_rows
    differs = np.zeros(n, dtype=bool)
    differs[:1] = True
    for name in ("_rule", "_key", "_lo", "_hi"):
        column = table.column(name).combine_chunks()
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        codes = column.dictionary_encode().indices.to_numpy()
        differs[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(differs)


def _count_groups(table: pa.Table, starts: np.ndarray, layout: _Layout, counters: dict[int, _Counter]) -> None:
    rows = _Rows(table, layout)
    ends = np.append(starts[1:], table.num_rows)
    rule = table.column("_rule").to_numpy()[starts]
    cells = (table.column("_lo").to_numpy() != table.column("_hi").to_numpy())[starts]
    sizes = ends - starts
    for i in np.unique(rule).tolist():
        counter = counters.setdefault(i, _Counter(layout))
        here = rule == i
        a, b = [], []
        for size in np.unique(sizes[here & ~cells & (sizes <= SMALL_GROUP)]).tolist():
            at = starts[here & ~cells & (sizes == size)]
            first, second = np.triu_indices(size, 1)
            a.append((at[:, None] + first[None, :]).ravel())
            b.append((at[:, None] + second[None, :]).ravel())
        if a:
            first, second = np.concatenate(a), np.concatenate(b)
            unlike = rows.ids[first] != rows.ids[second]
            first, second = first[unlike], second[unlike]
            for start in range(0, len(first), TILE_PAIRS):
                counter.pairs(rows, first[start:start + TILE_PAIRS], second[start:start + TILE_PAIRS])
        for at in np.flatnonzero(here & (cells | (sizes > SMALL_GROUP))).tolist():
            start, end = int(starts[at]), int(ends[at])
            if not cells[at]:
                counter.block(rows, slice(start, end), slice(start, end), True)
                continue
            # The rows of the lower part come first: their ids are lower.
            middle = start + int((rows.part[start:end] == rows.part[start]).sum())
            if middle < end:
                counter.block(rows, slice(start, middle), slice(middle, end), False)


def _counted(batches: Iterator[pa.RecordBatch], layout: _Layout) -> Iterator[pa.RecordBatch]:
    counters: dict[int, _Counter] = {}
    held: list[pa.RecordBatch] = []

    def whole_groups(last: bool) -> None:
        """Counts the groups held, but the last one while rows may follow."""
        table = pa.Table.from_batches(held)
        starts = _changes(table)
        held.clear()
        if not last and len(starts):
            rest = int(starts[-1])
            held.extend(table.slice(rest).combine_chunks().to_batches())
            table, starts = table.slice(0, rest).combine_chunks(), starts[:-1]
        if len(starts):
            _count_groups(table, starts, layout, counters)

    fresh = 0
    for batch in batches:
        held.append(batch)
        fresh += batch.num_rows
        # A group that goes on is looked at again only once it has doubled.
        if fresh >= CELL_ROWS and 2 * fresh >= sum(x.num_rows for x in held):
            whole_groups(False)
            fresh = 0
    if held:
        whole_groups(True)
    found: dict[tuple[int, ...], int] = {}
    for rule, counter in counters.items():
        for gammas, n in counter.patterns(rule):
            found[gammas] = found.get(gammas, 0) + n
    names = [g for g, _, _ in layout.gammas]
    columns = zip(*found) if found else [()] * len(names)
    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns], pa.array(found.values(), pa.int64())],
                                     names=[*names, "n"])


def pattern_counts(of: blocking.Candidates, settings: LinkSettings, copies: str | None = None) -> DataFrame:
    """(gammas, n_pairs) of the candidate pairs; with ``copies`` a pair counts
    as the product of that column's values."""
    layout = _layout(settings, of.rules)
    # Columns of a number keep the names they have; values are compared as text.
    recs = of.records.where(F.col(of.uid).isNotNull()).select(
        F.col(of.uid).alias("_id"), (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("_copies"),
        *[blocking.comparable(of.records, c).cast("string").alias(c) for c in layout.columns()])
    sizes = blocking.block_sizes(recs, of.rules)
    workload = blocking.rule_workload(sizes, CELL_ROWS)
    hot = blocking.bounded_blocks(recs, of.rules, CELL_ROWS, sizes, workload, "_id") if any(
        h for _, h in workload.values()) else None
    dealt = []
    for i, rule in enumerate(of.rules):
        keyed = recs.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in rule])).withColumn(
            "_key", blocking._key_string(rule))
        if workload.get(i, (0, 0))[1]:
            keyed = blocking._in_cells(keyed, "", rule, hot.where(F.col("rule") == i).drop("rule"), "_id")
        else:
            keyed = keyed.withColumns({"part": F.lit(0), "cell_lo": F.lit(0), "cell_hi": F.lit(0)})
        dealt.append(keyed.select(F.lit(i).alias("_rule"), "_key", F.col("cell_lo").alias("_lo"), F.col("cell_hi").alias("_hi"),
                                  F.col("part").alias("_part"), "_id", "_copies", *layout.columns()))
    group = ["_rule", "_key", "_lo", "_hi"]
    pairs = sum(p for p, _ in workload.values())
    parts = max(work_partitions(of.records.sparkSession, 0), math.ceil(pairs / PAIRS_PER_TASK))
    sorted_rows = (reduce(DataFrame.unionByName, dealt).repartition(parts, *group)
                   .sortWithinPartitions(*group, "_part", "_id"))
    gammas = [c.gamma for c in settings.comparisons]
    schema = ", ".join([*[f"`{g}` int" for g in gammas], "n long"])
    counted = sorted_rows.mapInArrow(lambda batches: _counted(batches, layout), schema)
    return counted.groupBy(*gammas).agg(F.sum("n").alias("n_pairs"))
