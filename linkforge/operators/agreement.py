"""Keys of the blocking joins for a score threshold.

A pair of a rule's block reaches a threshold only if it agrees in enough
further compared columns. From the parameters alone follow the least sets of
columns whose agreement can make up the weight that is missing (the others
taken at the best of their lower levels, or at 0 where a value may be missing).
``agreement_keys`` picks, for each rule, column sets of which every such least
set contains one: joining on the rule and these columns, one join for each
set, loses no pair that reaches the threshold, and the joins grow with the
pairs of the finer blocks instead of the square of the rule's blocks.

Which of the possible column sets are taken follows from how many pairs they
leave, estimated on the rows of least hash (PLAN_ROWS at most, the only rows
that reach the driver). The estimate decides the number of joins and their
cost, never which pairs are found.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model_params import ParameterSet
from ..session import ROWS_PER_WORK_PARTITION
from ..settings import LinkSettings

# Rows on which numbers of pairs are estimated.
PLAN_ROWS = 16_384
# One join more costs as much as one task's pairs, or as these for each record.
JOIN_PAIRS = ROWS_PER_WORK_PARTITION
JOIN_PAIRS_PER_ROW = 32
# Columns added to a rule at most; comparisons up to which sets are listed.
MOST_ADDED = 4
MOST_COMPARISONS = 14
# Slack against another order of summation.
_SLACK = 1e-6

Keys = list[tuple[str, ...]]


def _gains(records: DataFrame, params: ParameterSet, settings: LinkSettings, tf_adjust: bool):
    """(rows, {column: (most weight where equal, most where not)})."""
    adjusted = [c.column for c in settings.comparisons
                if tf_adjust and c.tf_adjust and params.u(c.column, c.exact_level)]
    if any(f"log2_tf_{c}" not in records.columns for c in adjusted):
        return None
    row = records.agg(F.count(F.lit(1)).alias("n"),
                      *[F.count(c.column).alias(f"held_{c.column}") for c in settings.comparisons],
                      *[F.min(f"log2_tf_{c}").alias(f"least_{c}") for c in adjusted]).first()
    gains = {}
    for comp in settings.comparisons:
        equal = params.log2_bf(comp.column, comp.exact_level)
        if comp.column in adjusted and row[f"least_{comp.column}"] is not None:
            u_exact = params.u(comp.column, comp.exact_level)
            equal = max(equal, equal + math.log2(u_exact) - row[f"least_{comp.column}"])
        unlike = max(params.log2_bf(comp.column, level) for level in comp.levels if level != comp.exact_level)
        if row[f"held_{comp.column}"] < row["n"]:
            unlike = max(unlike, 0.0)
        gains[comp.column] = (equal, unlike)
    return row["n"], gains


def least_agreements(rule: tuple[str, ...], gains: dict[str, tuple[float, float]], prior_weight: float,
                     threshold: float) -> list[frozenset[str]]:
    """The least sets of columns beyond the rule's whose agreement can bring a
    pair of its block to the threshold: an empty set if it may be there without
    any, none if it is out of reach."""
    free = [c for c in gains if c not in rule]
    missing = (threshold - _SLACK - prior_weight - sum(gains[c][0] for c in gains if c in rule)
               - sum(gains[c][1] for c in free))
    more = {c: gains[c][0] - gains[c][1] for c in free}
    found: list[frozenset[str]] = []
    useful = [c for c in free if more[c] > 0]
    for size in range(len(useful) + 1):
        for some in combinations(useful, size):
            if sum(more[c] for c in some) >= missing and not any(f <= set(some) for f in found):
                found.append(frozenset(some))
    return found


def _pair_share(codes: np.ndarray, held: np.ndarray) -> float:
    """Share of all pairs of the rows that agree in every column of ``codes``."""
    mixed = np.zeros(len(codes), dtype=np.uint64)
    for column in codes.T:
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    n = np.unique(mixed[held.all(axis=1)], return_counts=True)[1].astype(np.float64)
    total = len(codes) * (len(codes) - 1)
    return float((n * (n - 1)).sum() / total) if total else 0.0


def _cover(least: list[frozenset[str]], pairs_of, join_pairs: float) -> Keys:
    """Column sets, each least set containing one, at a low sum of pairs and
    joins: greedily by cost for each least set newly covered."""
    options = {frozenset(s) for one in least for size in range(min(MOST_ADDED, len(one)) + 1)
               for s in combinations(sorted(one), size)}
    cost = {s: pairs_of(s) + join_pairs for s in options}
    order = sorted(options, key=lambda s: (len(s), sorted(s)))
    taken, left = [], list(least)
    while left:
        best = min(order, key=lambda s: cost[s] / max(sum(s <= one for one in left), 1e-9))
        taken.append(best)
        left = [one for one in left if not best <= one]
    for s in sorted(taken, key=lambda s: -cost[s]):
        rest = [t for t in taken if t != s]
        if all(any(t <= one for t in rest) for one in least):
            taken = rest
    if frozenset() in options and cost[frozenset()] <= sum(cost[s] for s in taken):
        taken = [frozenset()]
    return [tuple(sorted(s)) for s in sorted(taken, key=lambda s: (cost[s], sorted(s)))]


def agreement_keys(records: DataFrame, params: ParameterSet, settings: LinkSettings, threshold: float | None,
                   tf_adjust: bool = False, join_pairs: float | None = None) -> dict[int, Keys] | None:
    """rule -> column sets to join on beside the rule's own columns, so that
    every pair at or above the threshold agrees in one of them; () stands for
    the rule alone, an empty list for a rule none of whose pairs can get there.
    None: no threshold, or the records lack term frequencies that count."""
    if threshold is None or len(settings.comparisons) > MOST_COMPARISONS:
        return None
    known = _gains(records, params, settings, tf_adjust)
    if known is None:
        return None
    rows, gains = known
    columns = list(dict.fromkeys([*settings.compared_columns, *[k for r in settings.blocking_rules for k in r]]))
    some = (records.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in columns],
                           F.xxhash64(settings.unique_id).alias("_order"))
                   .orderBy("_order").limit(PLAN_ROWS).drop("_order").toArrow())
    held = np.stack([some[c].is_valid().to_numpy() for c in columns], axis=1)
    codes = np.stack([some[c].fill_null(0).to_numpy().view(np.uint64) for c in columns], axis=1)
    if join_pairs is None:
        join_pairs = max(JOIN_PAIRS, JOIN_PAIRS_PER_ROW * rows)
    out = {}
    for i, rule in enumerate(settings.blocking_rules):
        def pairs_of(added, rule=rule):
            at = [columns.index(c) for c in dict.fromkeys([*rule, *sorted(added)])]
            return _pair_share(codes[:, at], held[:, at]) * rows * (rows - 1) / 2
        out[i] = _cover(least_agreements(rule, gains, params.prior_weight, float(threshold)), pairs_of, join_pairs)
    return out
