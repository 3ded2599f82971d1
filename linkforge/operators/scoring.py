"""Fellegi-Sunter scoring of comparison vectors.

match_weight = log2(prior / (1 - prior))
             + sum_c log2(m_c,gamma / u_c,gamma)                (gamma -1 adds 0)
             + sum_{c with TF, gamma exact} log2(u_c,exact / max(tf_l, tf_r))
match_probability = 2^w / (1 + 2^w)

Parameters are a few dozen numbers; they are compiled into literal
``CASE`` expressions, so scoring is a narrow projection inside codegen with
no join and no broadcast. Term-frequency logarithms come precomputed per
record.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model_params import ParameterSet
from ..settings import LinkSettings

# --- Fixed values: weight bands of the link summary ----------------------
WEIGHT_BANDS = [(15.0, "15+"), (10.0, "10-15"), (6.0, "6-10"), (2.0, "2-6")]
WEIGHT_BAND_ELSE = "<2"
# -------------------------------------------------------------------------


def bf_column(column: str) -> str:
    return f"bf_{column}"


def tf_adj_column(column: str) -> str:
    return f"bf_tf_adj_{column}"


def log2_bf_expr(params: ParameterSet, comp) -> Column:
    # A lookup names the level once: the threshold's filter is moved below the
    # projections, where a CASE would repeat the level's own CASE per level.
    by_level = F.array(*[F.lit(params.log2_bf(comp.column, level)) for level in sorted(comp.levels)])
    return F.coalesce(F.get(by_level, F.col(comp.gamma)), F.lit(0.0))


def tf_adjustment_expr(params: ParameterSet, comp, columns: list[str] | None = None) -> Column:
    """log2(u_exact / max(tf_l, tf_r)) on the exact level, else 0. Uses the
    per-record ``log2_tf_`` columns when present (no logarithm per pair)."""
    u_exact = params.u(comp.column, comp.exact_level)
    if not u_exact:
        return F.lit(0.0)
    exact = F.col(comp.gamma) == comp.exact_level
    if columns is not None and f"log2_tf_max_{comp.column}" in columns:
        adj = F.lit(math.log2(u_exact)) - F.col(f"log2_tf_max_{comp.column}")
    elif columns is None or f"log2_tf_{comp.column}_l" in columns:
        ltf = F.greatest(F.col(f"log2_tf_{comp.column}_l"), F.col(f"log2_tf_{comp.column}_r"))
        adj = F.lit(math.log2(u_exact)) - ltf
    else:
        tf = F.greatest(F.col(f"tf_{comp.column}_l"), F.col(f"tf_{comp.column}_r"))
        adj = F.log2(F.lit(u_exact) / tf)
    return F.coalesce(F.when(exact, adj), F.lit(0.0))


# Slack of the weight bound against another order of summation.
_REACH_SLACK = 1e-6
# A value stands in the bound as a hash of so many bits, so many to a long.
_CODE_BITS = 12
_CODES_PER_LONG = 5


def bound_columns(settings: LinkSettings) -> list[Column]:
    """Record columns that ``may_reach`` compares: short hashes of the compared
    values, packed into longs, and which of the values are there."""
    codes = [F.xxhash64(c.column).bitwiseAND(F.lit((1 << _CODE_BITS) - 1)) for c in settings.comparisons]
    packed = []
    for start in range(0, len(codes), _CODES_PER_LONG):
        shifted = [F.shiftleft(code, i * _CODE_BITS) for i, code in enumerate(codes[start:start + _CODES_PER_LONG])]
        packed.append(reduce(Column.bitwiseOR, shifted).alias(f"bound_{len(packed)}"))
    held = reduce(lambda a, b: a + b, [F.when(F.col(c.column).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
                                       for i, c in enumerate(settings.comparisons)])
    return [*packed, held.alias("bound_held")]


def may_reach(pairs: DataFrame, params: ParameterSet, settings: LinkSettings, threshold: float | None,
              tf_adjust: bool = False) -> DataFrame:
    """The pairs whose weight can reach the threshold, from equalities alone:
    values whose hashes are equal count as equal, others the best of the levels
    below equality, missing ones nothing. No pair that reaches it is left out,
    whatever the similarities; the pairs kept are still to be scored. The test
    becomes part of the blocking join's condition, so that most pairs are
    neither built as rows nor sent to the similarity function. Pairs without
    the records' ``bound_columns`` all stay."""
    if threshold is None or "bound_held_l" not in pairs.columns:
        return pairs
    held = F.col("bound_held_l").bitwiseAND(F.col("bound_held_r"))
    terms: list[Column] = [F.lit(params.prior_weight)]
    for i, comp in enumerate(settings.comparisons):
        levels = {level: params.log2_bf(comp.column, level) for level in comp.levels}
        below = max(v for level, v in levels.items() if level != comp.exact_level)
        # Hashes of unlike values may be equal: never less than below.
        exact = F.lit(max(levels[comp.exact_level], below))
        u_exact = params.u(comp.column, comp.exact_level)
        if tf_adjust and comp.tf_adjust and u_exact:
            if f"log2_tf_{comp.column}_l" not in pairs.columns:
                return pairs
            # max(tf_l, tf_r) is tf_l at least; a missing one leaves the pair in.
            own = F.coalesce(F.lit(math.log2(u_exact)) - F.col(f"log2_tf_{comp.column}_l"), F.lit(1e9))
            exact = F.greatest(F.lit(levels[comp.exact_level]) + own, F.lit(below))
        word, place = divmod(i, _CODES_PER_LONG)
        differs = F.col(f"bound_{word}_l").bitwiseXOR(F.col(f"bound_{word}_r")).bitwiseAND(
            F.lit(((1 << _CODE_BITS) - 1) << (place * _CODE_BITS)))
        terms.append(F.when(held.bitwiseAND(F.lit(1 << i)) == 0, F.lit(0.0)).when(differs == 0, exact).otherwise(F.lit(below)))
    return pairs.where(reduce(lambda a, b: a + b, terms) >= F.lit(float(threshold) - _REACH_SLACK))


def score_pairs(gammas: DataFrame, params: ParameterSet, settings: LinkSettings | None = None,
                threshold: float | None = None, tf_adjust: bool = False) -> DataFrame:
    """Adds ``bf_<col>`` (log2 Bayes factors), optional ``bf_tf_adj_<col>``,
    ``match_weight`` and ``match_probability``; keeps pairs with weight >= threshold."""
    settings = settings or LinkSettings()
    terms: list[Column] = [F.lit(params.prior_weight)]
    extra = []
    for comp in settings.comparisons:
        extra.append(log2_bf_expr(params, comp).alias(bf_column(comp.column)))
        terms.append(F.col(bf_column(comp.column)))
    if tf_adjust:
        for comp in settings.comparisons:
            if comp.tf_adjust:
                extra.append(tf_adjustment_expr(params, comp, gammas.columns)
                             .alias(tf_adj_column(comp.column)))
                terms.append(F.col(tf_adj_column(comp.column)))
    scored = gammas.select("*", *extra)
    w = reduce(lambda a, b: a + b, terms)
    # 2^w / (1 + 2^w) written with one reference to w, so the optimizer
    # never inlines the weight expression twice into the projection.
    scored = scored.withColumn("match_weight", w).withColumn(
        "match_probability", F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight"))))
    if threshold is not None:
        scored = scored.where(F.col("match_weight") >= F.lit(float(threshold)))
    return scored


def weight_band(col: str = "match_weight") -> Column:
    c = F.col(col)
    e = None
    for lower, label in WEIGHT_BANDS:
        e = F.when(c >= lower, F.lit(label)) if e is None else e.when(c >= lower, F.lit(label))
    return e.otherwise(F.lit(WEIGHT_BAND_ELSE))


def weight_bands(predictions: DataFrame) -> DataFrame:
    """Pair counts per weight band, ordered by band label (text order)."""
    return (predictions.groupBy(weight_band().alias("weight_band"))
                       .agg(F.count(F.lit(1)).alias("n_pairs"))
                       .orderBy("weight_band"))


def top_pairs(predictions: DataFrame, n: int = 10, id_col: str = "uei") -> DataFrame:
    """Highest-weight pairs, weight rounded to 2 dp; ties broken by ids."""
    return (predictions.orderBy(F.col("match_weight").desc(), F.col(f"{id_col}_l"), F.col(f"{id_col}_r"))
                       .limit(n)
                       .select(f"{id_col}_l", f"{id_col}_r", "name_norm_l", "name_norm_r",
                               "phys_city_l", "phys_city_r",
                               F.round("match_weight", 2).alias("weight")))


def edges_above(predictions: DataFrame, threshold: float, id_col: str = "uei") -> DataFrame:
    """Graph edges: pairs with weight >= threshold (inclusive)."""
    return (predictions.where(F.col("match_weight") >= F.lit(float(threshold)))
                       .select(f"{id_col}_l", f"{id_col}_r", "match_weight", "match_probability"))
