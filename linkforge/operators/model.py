"""Parameter estimation for the Fellegi-Sunter model.

* Term frequencies: value count / non-null count per column (one
  aggregation per column), joined onto the *records* before pairing.
* u probabilities: level frequencies among random record pairs. Pairs are
  drawn without a cross join: each record draws one slot out of ``n``; each
  record also claims ``K`` consecutive slots from a hashed start, and an
  equi-join on the slot pairs it with the records that drew those slots.
  Only slots below a limit ``T`` count, chosen so that the expected number of
  pairs, (n - 1) K T / 2n, is ``min(max_pairs, n(n-1)/2)`` at every n; beyond
  n = 2 max_pairs just the records of those slots are shuffled. With
  ``K = T = n`` every pair appears exactly once. Slot groups are hash-random
  (about one record each), so no group is hot. The hash is md5-based so the
  same sample can be reproduced in any SQL engine.
* m probabilities: EM with u fixed. Spark reduces the training pairs to
  agreement-pattern counts (a partial aggregation; the table is bounded by
  the product of level counts, independent of the data size), and the EM
  iterations run over that small table.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model_params import ParameterSet
from ..session import materialize, work_partitions
from ..settings import LinkSettings
from . import blocking, comparisons, pair_patterns

LEVEL_FLOOR = 1e-6
DEFAULT_M_EXACT = 0.95
MAX_PASS_PRIOR = 0.5


# ---------------------------------------------------------------- TF ----

def term_frequencies(records: DataFrame, column: str) -> DataFrame:
    """(value, tf): relative frequency of each non-null value."""
    vals = records.where(F.col(column).isNotNull())
    total = vals.agg(F.count(F.lit(1))).scalar()
    return (vals.groupBy(column).agg(F.count(F.lit(1)).alias("value_count"))
                .select(F.col(column).alias("value"), "value_count",
                        (F.col("value_count") / total).alias("tf")))


def with_term_frequencies(records: DataFrame, settings: LinkSettings | None = None) -> DataFrame:
    """Adds ``tf_<col>`` and ``log2_tf_<col>`` for every TF-adjusted column.
    The logarithm is taken once per record here, so pair scoring only
    subtracts (log2 max(tf_l, tf_r) = max(log2 tf_l, log2 tf_r))."""
    settings = settings or LinkSettings()
    columns = [c.column for c in settings.comparisons if c.tf_adjust]
    # One written table for all columns: both sides of each join below are then
    # plain shuffles, whose hot values AQE can split.
    tables = [term_frequencies(records, c).select(F.lit(c).alias("column"), "value", "tf") for c in columns]
    if not tables:
        return records
    written = materialize(reduce(DataFrame.unionByName, tables), "term-frequencies")
    # Records without a value match nothing; a key of their own each keeps
    # them from meeting in one task.
    alone = F.concat(F.lit("\u0001"), F.xxhash64(settings.unique_id).cast("string"))
    out = records
    for c in columns:
        tf = written.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("tf").alias(f"tf_{c}"), F.log2("tf").alias(f"log2_tf_{c}"))
        out = out.withColumn("_key", F.coalesce(c, alone)).join(tf, F.col("_key") == F.col("_value"), "left").drop("_key", "_value")
    return out


# ------------------------------------------------------- random pairs ----

SLOT_HEX_DIGITS = 15  # 60 bits: slots stay even for any number of records


def _hash_slot(key: Column, salt: str, slots: int) -> Column:
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(salt))), 1, SLOT_HEX_DIGITS), 16, 10).cast("long")
    return F.pmod(h, F.lit(slots))


def random_pair_plan(n: int, max_pairs: int) -> tuple[int, int, int]:
    """(slots, claims per record, slots that count) for an expected
    min(max_pairs, all pairs) pairs."""
    slots = max(n, 1)
    if n < 2:
        return slots, 0, 0
    if n * (n - 1) // 2 <= max_pairs:
        return slots, slots, slots
    claims = min(slots, -(-2 * max_pairs // (n - 1)))
    return slots, claims, min(slots, round(2 * max_pairs * n / ((n - 1) * claims)))


def random_pairs(records: DataFrame, max_pairs: int, seed: int = 42, id_col: str = "uei",
                 carry: list[str] | None = None) -> DataFrame:
    cols = [id_col] + [c for c in (carry or []) if c != id_col]
    n = records.count()
    slots, claims, counting = random_pair_plan(n, max_pairs)
    recs = records.select(*cols)
    # Sized by the pairs the sample will produce (about min(max_pairs, all pairs)).
    parts = work_partitions(records.sparkSession, 2.0 * min(max_pairs, n * (n - 1) / 2))
    start = _hash_slot(F.col(f"{id_col}_l"), f":a{seed}", slots)
    left = recs.select([F.col(c).alias(f"{c}_l") for c in cols]).withColumn("_start", start)
    if claims > 1:  # few records: spread them before the K-fold explode
        left = left.repartition(parts, "_start").withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(claims - 1))))
        left = left.select("*", F.pmod(F.col("_start") + F.col("_k"), F.lit(slots)).alias("_slot")).drop("_start", "_k")
    else:
        left = left.withColumnRenamed("_start", "_slot")
    right = (recs.select([F.col(c).alias(f"{c}_r") for c in cols])
                 .withColumn("_slot", _hash_slot(F.col(f"{id_col}_r"), f":b{seed}", slots)))
    in_sample = F.col("_slot") < F.lit(counting)
    left = left.where(in_sample).repartition(parts, "_slot")
    right = right.where(in_sample).repartition(parts, "_slot")
    return (left.join(right, "_slot").where(F.col(f"{id_col}_l") < F.col(f"{id_col}_r"))
                .drop("_slot"))


def u_estimates(records: DataFrame, settings: LinkSettings | None = None,
                max_pairs: int | None = None) -> DataFrame:
    """(comparison, gamma, u_probability): level frequencies among random
    pairs (non-null levels only).

    The sampled pairs are scored where the slot join leaves them and reduced
    to agreement-pattern counts by a map-side combined aggregation, so neither
    wide pair rows nor string pairs (nearly all distinct) are shuffled again."""
    settings = settings or LinkSettings()
    max_pairs = max_pairs or settings.u_max_pairs
    pairs = random_pairs(records, max_pairs, settings.seed, settings.unique_id,
                         settings.compared_columns)
    patterns = comparisons.gamma_patterns(comparisons.gamma_vectors(pairs, settings, keep_scores=False), settings)
    stacked = F.inline(F.array(*[F.struct(F.lit(c.column).alias("comparison"), F.col(c.gamma).alias("gamma"))
                                 for c in settings.comparisons]))
    counts = (materialize(patterns, "u-patterns").select(stacked, "n_pairs").where(F.col("gamma") >= 0)
              .groupBy("comparison", "gamma").agg(F.sum("n_pairs").alias("n_pairs")))
    w = Window.partitionBy("comparison")  # <= a few dozen rows in all
    return counts.select("comparison", "gamma",
                         (F.col("n_pairs") / F.sum("n_pairs").over(w)).alias("u_probability"))


# ---------------------------------------------------------------- EM ----

def _floor_normalise(values: dict[int, float], levels: list[int]) -> dict[int, float]:
    v = {k: max(values.get(k, 0.0) or 0.0, LEVEL_FLOOR) for k in levels}
    s = sum(v.values())
    return {k: x / s for k, x in v.items()}


def default_m(comp) -> dict[int, float]:
    levels = comp.levels
    rest = (1.0 - DEFAULT_M_EXACT) / (len(levels) - 1)
    return {k: (DEFAULT_M_EXACT if k == comp.exact_level else rest) for k in levels}


def parameters_from_u(u_table: DataFrame | list, settings: LinkSettings) -> ParameterSet:
    """Start parameters: estimated u (floored), default m, global prior."""
    rows = u_table.collect() if isinstance(u_table, DataFrame) else u_table
    u_by = {}
    for r in rows:
        u_by.setdefault(r["comparison"], {})[int(r["gamma"])] = float(r["u_probability"])
    levels = {}
    for comp in settings.comparisons:
        u = _floor_normalise(u_by.get(comp.column, {}), comp.levels)
        m = default_m(comp)
        for k in comp.levels:
            levels[(comp.column, k)] = {"m": m[k], "u": u[k]}
    return ParameterSet(settings.prior, levels)


def collect_patterns(patterns: DataFrame, settings: LinkSettings) -> tuple[np.ndarray, np.ndarray]:
    """Bring the pattern-count table to the driver. Its size is bounded by
    the product of the comparisons' level counts (checked)."""
    bound = 1
    for c in settings.comparisons:
        bound *= len(c.levels) + 1
    cols = [c.gamma for c in settings.comparisons]
    rows = patterns.select(*cols, "n_pairs").limit(bound + 1).collect()
    if len(rows) > bound:
        raise RuntimeError("pattern table exceeds its theoretical bound")
    if not rows:
        return np.zeros((0, len(cols)), dtype=np.int64), np.zeros(0)
    g = np.array([[r[c] for c in cols] for r in rows], dtype=np.int64)
    n = np.array([r["n_pairs"] for r in rows], dtype=np.float64)
    return g, n


def _log_prob_table(params: ParameterSet, settings, key: str, active: list[int], g: np.ndarray) -> np.ndarray:
    out = np.zeros(g.shape[0])
    for j in active:
        comp = settings.comparisons[j]
        col = np.zeros(g.shape[0])
        for k in comp.levels:
            col[g[:, j] == k] = math.log(params.levels[(comp.column, k)][key])
        out += col
    return out


def em_step(params: ParameterSet, settings: LinkSettings, g: np.ndarray, n: np.ndarray,
            active: list[int], prior: float) -> tuple[ParameterSet, float, np.ndarray]:
    """One expectation + maximisation step on pattern counts. Returns the
    new parameters, the new in-pass prior and the match posteriors."""
    lm = _log_prob_table(params, settings, "m", active, g) + math.log(prior)
    lu = _log_prob_table(params, settings, "u", active, g) + math.log(1 - prior)
    top = np.maximum(lm, lu)
    p = np.exp(lm - top) / (np.exp(lm - top) + np.exp(lu - top))
    pn = p * n
    new_levels = {k: dict(v) for k, v in params.levels.items()}
    for j in active:
        comp = settings.comparisons[j]
        denom = pn[g[:, j] >= 0].sum()
        raw = {k: (pn[g[:, j] == k].sum() / denom if denom > 0 else 0.0) for k in comp.levels}
        m = _floor_normalise(raw, comp.levels)
        for k in comp.levels:
            new_levels[(comp.column, k)]["m"] = m[k]
    new_prior = float(pn.sum() / n.sum()) if n.sum() > 0 else prior
    return ParameterSet(params.prior, new_levels), new_prior, p


def _pass_prior(params: ParameterSet, settings: LinkSettings, blocked: list[str]) -> float:
    odds = params.prior / (1 - params.prior)
    for c in blocked:
        if c in settings.compared_columns:
            comp = settings.comparison(c)
            k = comp.exact_level
            odds *= params.levels[(c, k)]["m"] / params.levels[(c, k)]["u"]
    return min(odds / (1 + odds), MAX_PASS_PRIOR)


def training_patterns(records: DataFrame, block: tuple[str, ...], settings: LinkSettings) -> DataFrame:
    """Pattern counts of all pairs of records that agree on ``block``, without
    listing pairs of like records: records with the same compared values are
    one profile with a count, pairs of profiles weigh the product of their
    counts, and the pairs within a profile are counted by n(n-1)/2. However
    many records share all their values, they are one row of a block."""
    cols = list(dict.fromkeys([*settings.compared_columns, *block]))
    keyed = records.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in block]))
    profiles = materialize(keyed.groupBy(*cols).agg(
        F.min(settings.unique_id).alias(settings.unique_id), F.count(F.lit(1)).alias("copies")), "training-profiles")
    gammas = [c.gamma for c in settings.comparisons]
    between = pair_patterns.pattern_counts(blocking.Candidates(profiles, (tuple(block),), settings.unique_id), settings,
                                           copies="copies").withColumnRenamed("n_pairs", "n")
    alike = [F.when(F.col(c.column).isNull(), F.lit(-1)).otherwise(F.lit(c.exact_level)).alias(c.gamma)
             for c in settings.comparisons]
    within = profiles.where("copies > 1").select(*alike, F.expr("copies * (copies - 1) div 2").alias("n"))
    return between.unionByName(within).groupBy(*gammas).agg(F.sum("n").alias("n_pairs"))


def listed_patterns(records: DataFrame, block: tuple[str, ...], settings: LinkSettings) -> DataFrame:
    """Pattern counts of the pairs of records that agree on ``block``, counted
    where the blocks are: no pair becomes a row, and only pairs with a
    similarity to compute are scored."""
    return pair_patterns.pattern_counts(blocking.Candidates(records, (tuple(block),), settings.unique_id), settings)


def em_pass(params: ParameterSet, settings: LinkSettings, patterns: DataFrame,
            block: tuple[str, ...]) -> tuple[ParameterSet, list[str], int]:
    """EM with u fixed over the pairs of one training block. Columns of the
    block are not trained (every pair agrees on them by construction)."""
    g, n = collect_patterns(patterns, settings)
    active = [j for j, c in enumerate(settings.comparisons) if c.column not in block]
    prior = _pass_prior(params, settings, list(block))
    trained = [settings.comparisons[j].column for j in active]
    iterations = 0
    if g.shape[0] == 0:
        return params, [], 0
    for iterations in range(1, settings.max_iterations + 1):
        new, prior, _ = em_step(params, settings, g, n, active, prior)
        delta = max(abs(new.levels[k]["m"] - params.levels[k]["m"]) for k in new.levels)
        params = new
        if delta < settings.em_convergence:
            break
    return params, trained, iterations


def covered_by_rules(block: tuple[str, ...], rules) -> bool:
    """Pairs agreeing on every key of ``block`` agree on some blocking rule,
    so they are all candidate pairs already."""
    return any(set(rule) <= set(block) for rule in rules)


def block_patterns(records: DataFrame, block: tuple[str, ...], settings: LinkSettings,
                   candidate_gammas: DataFrame | None = None, listed: bool = False) -> DataFrame:
    """Pattern counts of the pairs agreeing on ``block``: of a block that
    implies a blocking rule from the candidate comparison vectors where they
    are stored, or (``listed``) from the same pairs by a join on the block;
    else from a dedicated blocking join."""
    if listed and covered_by_rules(block, settings.blocking_rules):
        return listed_patterns(records, block, settings)
    if candidate_gammas is not None and covered_by_rules(block, settings.blocking_rules):
        agree = reduce(lambda a, b: a & b, [F.col(f"{k}_l") == F.col(f"{k}_r") for k in block])
        return comparisons.gamma_patterns(candidate_gammas.where(agree), settings)
    return training_patterns(records, block, settings)


def train(records: DataFrame, settings: LinkSettings | None = None,
          max_pairs: int | None = None, candidate_gammas: DataFrame | None = None,
          listed: bool = False) -> ParameterSet:
    """u by random sampling, then one EM pass per training block; a
    comparison's m is the mean over the passes that trained it."""
    settings = settings or LinkSettings()
    start = parameters_from_u(u_estimates(records, settings, max_pairs), settings)
    trained_m: dict[tuple[str, int], list[float]] = {}
    for block in settings.training_blocks:
        patterns = block_patterns(records, block, settings, candidate_gammas, listed)
        params, trained, _ = em_pass(start, settings, patterns, block)
        for c in trained:
            for k in settings.comparison(c).levels:
                trained_m.setdefault((c, k), []).append(params.levels[(c, k)]["m"])
    levels = {k: dict(v) for k, v in start.levels.items()}
    for key, ms in trained_m.items():
        levels[key]["m"] = float(sum(ms) / len(ms))
    return ParameterSet(settings.prior, levels)


def em_one_step_frame(patterns: DataFrame, params: ParameterSet, settings: LinkSettings) -> DataFrame:
    """One E+M step over a pattern-count table, as a Spark plan: the new m per
    (comparison, gamma) for every comparison, plus the new match share."""
    def log_of(key: str) -> Column:
        terms = []
        for comp in settings.comparisons:
            e = None
            for k in comp.levels:
                v = F.lit(math.log(params.levels[(comp.column, k)][key]))
                e = F.when(F.col(comp.gamma) == k, v) if e is None else e.when(F.col(comp.gamma) == k, v)
            terms.append(e.otherwise(F.lit(0.0)))
        return reduce(lambda a, b: a + b, terms)

    # Read twice below, and small.
    patterns = materialize(patterns, "em-patterns")
    lam = params.prior
    lm = log_of("m") + F.lit(math.log(lam))
    lu = log_of("u") + F.lit(math.log(1 - lam))
    post = patterns.select("*", (F.lit(1.0) / (F.lit(1.0) + F.exp(lu - lm))).alias("p"))
    post = post.withColumn("pn", F.col("p") * F.col("n_pairs"))
    share = post.agg((F.sum("pn") / F.sum("n_pairs")).alias("s")).scalar()
    stacked = F.inline(F.array(*[F.struct(F.lit(c.column).alias("comparison"),
                                          F.col(c.gamma).alias("gamma"))
                                 for c in settings.comparisons]))
    per = (post.select(stacked, "pn").where(F.col("gamma") >= 0)
               .groupBy("comparison", "gamma").agg(F.sum("pn").alias("pn")))
    w = Window.partitionBy("comparison")
    return per.select("comparison", "gamma", (F.col("pn") / F.sum("pn").over(w)).alias("m_probability"),
                      share.alias("match_share"))
