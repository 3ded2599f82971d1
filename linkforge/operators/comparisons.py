"""Comparison vectors: one gamma level per comparison column for each pair.

Exact comparisons are pure column expressions. Jaro-Winkler comparisons
score only the pairs whose answer is not already known:
  * either side NULL          -> gamma -1 (not scored)
  * both sides equal          -> exact level (not scored)
  * length bound < threshold  -> level 0 (not scored)
The scores are computed in the same projection as the pairs (an Arrow
batched UDF, no shuffle); repeated string pairs are scored once per worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jaro import jaro_winkler_udf, upper_bound
from ..settings import Comparison, LinkSettings
from . import blocking, pair_patterns

# Bound slack so float rounding in the bound can never skip a pair that
# would reach the threshold.
_BOUND_SLACK = 1e-9


def jw_column(column: str) -> str:
    return f"jw_{column}"


def needs_jaro(column: str, min_threshold: float) -> Column:
    l, r = F.col(f"{column}_l"), F.col(f"{column}_r")
    return F.coalesce(
        l.isNotNull() & r.isNotNull() & (l != r)
        & (upper_bound(l, r) + F.lit(_BOUND_SLACK) >= F.lit(min_threshold)),
        F.lit(False))


def level_by_equality(comp: Comparison) -> Column:
    """The level that equality alone gives: -1, the exact one or 0."""
    l, r = F.col(f"{comp.column}_l"), F.col(f"{comp.column}_r")
    return (F.when(l.isNull() | r.isNull(), F.lit(-1)).when(l == r, F.lit(comp.exact_level))
             .otherwise(F.lit(0)).cast("int"))


def _level_column(column: str) -> str:
    return f"_level_{column}"


def _scored_column(column: str, side: str) -> str:
    return f"_scored_{column}{side}"


def gamma_expr(comp: Comparison) -> Column:
    """The level from what ``gamma_vectors`` has computed before the similarity."""
    level, jw = F.col(_level_column(comp.column)), F.col(jw_column(comp.column))
    if comp.kind != "jaro_winkler":
        return level
    g = F.when(F.col(_scored_column(comp.column, "_l")).isNull(), level)
    for at, t in zip(range(comp.exact_level - 1, 0, -1), comp.thresholds):
        g = g.when(jw >= F.lit(t), F.lit(at))
    return g.otherwise(F.lit(0)).cast("int")


def gamma_vectors(pairs: DataFrame, settings: LinkSettings | None = None,
                  keep_scores: bool = True) -> DataFrame:
    """Pairs plus ``gamma_<col>`` for every comparison (and ``jw_<col>``
    similarity columns for the fuzzy ones when ``keep_scores``). One Python
    pass evaluates every fuzzy comparison; no shuffle. What equality decides is
    computed before that pass, so that the compared values which nothing later
    reads don't ride through it. The UDF runs on every row (Spark evaluates
    Python UDFs outside ``CASE``), so rows that need no score pass NULL strings
    in, which it skips without work."""
    settings = settings or LinkSettings()
    fuzzy = [c for c in settings.comparisons if c.kind == "jaro_winkler"]
    known = [level_by_equality(c).alias(_level_column(c.column)) for c in settings.comparisons]
    for c in fuzzy:
        need = needs_jaro(c.column, min(c.thresholds))
        known += [F.when(need, F.col(f"{c.column}{s}")).alias(_scored_column(c.column, s)) for s in ("_l", "_r")]
    out = pairs.select("*", *known)
    out = out.select("*", *[jaro_winkler_udf(*[F.col(_scored_column(c.column, s)) for s in ("_l", "_r")])
                            .alias(jw_column(c.column)) for c in fuzzy])
    out = out.select("*", *[gamma_expr(c).alias(c.gamma) for c in settings.comparisons])
    out = out.drop(*[_level_column(c.column) for c in settings.comparisons],
                   *[_scored_column(c.column, s) for c in fuzzy for s in ("_l", "_r")])
    if not keep_scores:
        out = out.drop(*[jw_column(c.column) for c in fuzzy])
    return blocking.with_candidates(out, blocking.candidates_of(pairs))


def lean_gammas(gammas: DataFrame, settings: LinkSettings | None = None,
                keep: tuple[str, ...] = ("name_norm", "phys_city")) -> DataFrame:
    """What later stages read: ids, rule, gammas, term frequencies, the
    columns reports show, and the columns training blocks test for equality."""
    settings = settings or LinkSettings()
    uid = settings.unique_id
    cols: list = [f"{uid}_l", f"{uid}_r", "match_key"] + [c.gamma for c in settings.comparisons]
    # Training blocks that imply a blocking rule are filtered from these rows
    # (their equality columns stay); other blocks get their own join.
    covered = [b for b in settings.training_blocks
               if any(set(rule) <= set(b) for rule in settings.blocking_rules)]
    for c in keep + tuple(k for b in covered for k in b):
        for side in ("_l", "_r"):
            if f"{c}{side}" in gammas.columns and f"{c}{side}" not in cols:
                cols.append(f"{c}{side}")
    # Scoring needs only max(log2 tf_l, log2 tf_r) per TF column.
    for comp in settings.comparisons:
        if f"log2_tf_{comp.column}_l" in gammas.columns:
            cols.append(F.greatest(f"log2_tf_{comp.column}_l", f"log2_tf_{comp.column}_r")
                        .alias(f"log2_tf_max_{comp.column}"))
    return blocking.with_candidates(gammas.select(*cols), blocking.candidates_of(gammas))


def jaro_winkler_pairs(pairs: DataFrame, column: str) -> DataFrame:
    """Similarity of every distinct non-null string pair of a compared column."""
    l, r = f"{column}_l", f"{column}_r"
    of = blocking.candidates_of(pairs)
    values = (blocking.value_pairs(of, column) if of is not None
              else pairs.where(F.col(l).isNotNull() & F.col(r).isNotNull()).select(l, r).distinct())
    return (values.withColumn("similarity", F.when(F.col(l) == F.col(r), F.lit(1.0))
                             .otherwise(jaro_winkler_udf(F.col(l), F.col(r)))))


def gamma_patterns(gammas: DataFrame, settings: LinkSettings | None = None) -> DataFrame:
    """Agreement-pattern counts: the sufficient statistics of EM. At most
    the product of level counts rows, whatever the number of pairs. The vectors
    of all candidate pairs are counted where their blocks are (``pair_patterns``)."""
    settings = settings or LinkSettings()
    of = blocking.candidates_of(gammas)
    if of is not None:
        return pair_patterns.pattern_counts(of, settings)
    cols = [c.gamma for c in settings.comparisons]
    return gammas.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_pairs"))
