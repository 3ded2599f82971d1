import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkforge.functions.jaro import jaro_winkler
from linkforge.operators import blocking, comparisons, pair_patterns
from linkforge.settings import Comparison, LinkSettings

COLS = ["name", "dba", "city", "zip", "first", "weight"]
SET = LinkSettings(
    unique_id="id", blocking_rules=(("zip", "first"), ("name",), ("city",)), training_blocks=(("name",),),
    comparisons=(Comparison("name", "jaro_winkler", (0.92, 0.85, 0.7)), Comparison("city"), Comparison("zip"),
                 Comparison("dba", "jaro_winkler", (0.88,))))
SCHEMA = "id string, name string, dba string, city string, zip string, first string, weight long"


def _rows(n, seed=1, ids=None):
    rnd = random.Random(seed)
    names = ["acme", "acme tools", "acme tool", "bolt", "bolt works", "blot works", "crate", "trace", ""]
    out = []
    for i in range(n):
        name = rnd.choice([*names, *names, None])
        out.append((f"{i:05d}" if ids is None else rnd.choice([None, *[f"{k:05d}" for k in range(ids)]]), name,
                    rnd.choice([None, "red", "reed", "green"]), rnd.choice([None, "A", "B", "C"]),
                    rnd.choice(["1", "2", "3", None]), name[:1] if name else None, rnd.choice([1, 1, 1, 3])))
    return out


def _level(comp, a, b):
    if a is None or b is None:
        return -1
    if a == b:
        return comp.exact_level
    score = jaro_winkler(a, b)
    return next((comp.exact_level - 1 - i for i, t in enumerate(comp.thresholds) if score >= t), 0)


def _brute(rows, rules, weighted=False):
    at, out = {c: i + 1 for i, c in enumerate(COLS)}, Counter()
    for a, b in itertools.combinations(rows, 2):
        if a[0] is None or b[0] is None or a[0] == b[0]:
            continue
        l, r = (a, b) if a[0] < b[0] else (b, a)
        if any(all(l[at[c]] is not None and l[at[c]] == r[at[c]] for c in rule) for rule in rules):
            out[tuple(_level(c, l[at[c.column]], r[at[c.column]]) for c in SET.comparisons)] += a[-1] * b[-1] if weighted else 1
    return dict(out)


def _found(df):
    return {tuple(r)[:-1]: r[-1] for r in df.collect()}


@pytest.mark.parametrize("cell_rows", [10_000, 30])
@pytest.mark.parametrize("ids", [None, 150])
def test_counts_equal_brute_force(spark, monkeypatch, cell_rows, ids):
    monkeypatch.setattr(pair_patterns, "CELL_ROWS", cell_rows)
    rows = _rows(260, ids=ids)
    of = blocking.Candidates(spark.createDataFrame(rows, SCHEMA), SET.blocking_rules, "id")
    assert _found(pair_patterns.pattern_counts(of, SET)) == _brute(rows, SET.blocking_rules)
    of = blocking.Candidates(of.records, (("zip",),), "id")
    assert _found(pair_patterns.pattern_counts(of, SET, copies="weight")) == _brute(rows, (("zip",),), weighted=True)


@pytest.mark.parametrize("small", [dict(TILE_PAIRS=50), dict(MOST_BINS=1), dict(KEPT_LEVELS=1), dict(CELL_ROWS=7),
                                   dict(SMALL_GROUP=1, SCORED_AT_ONCE=3)])
def test_counts_do_not_depend_on_limits(monkeypatch, small):
    """The task's part alone: batches that cut groups, tiles, histograms that don't fit."""
    for name, value in small.items():
        monkeypatch.setattr(pair_patterns, name, value)
    rules = (("city",),)
    rows = sorted((r for r in _rows(150, seed=3, ids=140) if r[0] is not None and r[3] is not None), key=lambda r: (r[3], r[0]))
    layout = pair_patterns._layout(SET, rules)
    table = pa.table({"_rule": pa.array([0] * len(rows), pa.int32()), "_key": [r[3] for r in rows],
                      "_lo": pa.array(np.zeros(len(rows), np.int32)), "_hi": pa.array(np.zeros(len(rows), np.int32)),
                      "_part": pa.array(np.zeros(len(rows), np.int32)), "_id": [r[0] for r in rows],
                      "_copies": pa.array([1] * len(rows), pa.int64()),
                      **{c: pa.array([r[COLS.index(c) + 1] for r in rows], pa.string()) for c in layout.columns()}})
    out = pa.Table.from_batches(pair_patterns._counted(iter(table.to_batches(max_chunksize=9)), layout)).to_pylist()
    assert {tuple(r.values())[:-1]: r["n"] for r in out} == _brute(rows, rules)


def test_patterns_of_all_candidates_list_no_pair(spark):
    rows = [r for r in _rows(80, seed=9) if r[1] != ""]
    records = spark.createDataFrame(rows, SCHEMA)
    pairs = blocking.candidate_pairs(records, SET, carry=COLS)
    fail = pairs.select(*[F.raise_error(F.lit("listed")).cast(t).alias(c) for c, t in pairs.dtypes])
    vectors = comparisons.gamma_vectors(blocking.with_candidates(fail, blocking.candidates_of(pairs)), SET)
    got = comparisons.gamma_patterns(vectors, SET)
    assert _found(got) == _brute(rows, SET.blocking_rules)
    assert got.dtypes == comparisons.gamma_patterns(vectors.select("*"), SET).dtypes
    # pairs left out by a filter are left out
    some = comparisons.gamma_vectors(pairs, SET).where("match_key = 1")
    assert sum(_found(comparisons.gamma_patterns(some, SET)).values()) == some.count()
    empty = blocking.candidate_pairs(records.limit(0), SET, carry=COLS)
    assert comparisons.gamma_patterns(comparisons.gamma_vectors(empty, SET), SET).count() == 0
