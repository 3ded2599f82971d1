"""Stage composition: link input -> pairs -> comparison vectors -> scores
-> edges -> clusters. Mirrors the reference's stage tables; each stage's
output that several consumers read is written as a Parquet table in the
shared checkpoint folder (lineage cut, survives executor loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model_params import ParameterSet
from ..operators import agreement, blocking, comparisons, graph, model, scoring
from ..session import ensure_checkpoint_dir, materialize
from ..settings import DEFAULT_CLUSTER_THRESHOLD, DEFAULT_PREDICT_THRESHOLD, LinkSettings


def link_records(link_input: DataFrame, settings: LinkSettings, tf: bool = False) -> DataFrame:
    """The narrow record set the linkage reads (column pruning before the
    self-joins), with term frequencies when TF adjustment is on."""
    recs = link_input.select(*settings.record_columns())
    return model.with_term_frequencies(recs, settings) if tf else recs


def comparison_stage(records: DataFrame, settings: LinkSettings) -> DataFrame:
    """Candidate pairs -> comparison vectors in one pass (the wide pair rows
    are never materialised); the lean result is written because both
    training and scoring read it."""
    # Only what the comparisons and scoring read rides through the join (the
    # raw term frequencies stay on the records; their logarithms travel).
    carry = [c for c in records.columns if not c.startswith("tf_")]
    pairs = blocking.candidate_pairs(records, settings, carry=carry)
    return materialize(comparisons.lean_gammas(
        comparisons.gamma_vectors(pairs, settings, keep_scores=False), settings), "gammas")


def score_stage(gammas: DataFrame, params: ParameterSet, settings: LinkSettings,
                threshold: float | None = DEFAULT_PREDICT_THRESHOLD, tf: bool = False) -> DataFrame:
    return scoring.score_pairs(gammas, params, settings, threshold=threshold, tf_adjust=tf)


def reaching_pairs(records: DataFrame, params: ParameterSet, settings: LinkSettings,
                   threshold: float | None = DEFAULT_PREDICT_THRESHOLD, tf: bool = False,
                   join_pairs: float | None = None) -> DataFrame:
    """The candidate pairs that can reach the threshold, with all columns of
    the records: blocks are joined on the further columns in which such a pair
    must agree, and of the pairs that meet those whose equal values leave the
    threshold out of reach end in the join."""
    keyed = records.select("*", *scoring.bound_columns(settings))
    agreeing = agreement.agreement_keys(records, params, settings, threshold, tf, join_pairs)
    pairs = blocking.candidate_pairs(keyed, settings, carry=keyed.columns, agreeing=agreeing)
    return scoring.may_reach(pairs, params, settings, threshold, tf)


def prediction_stage(records: DataFrame, params: ParameterSet, settings: LinkSettings,
                     threshold: float | None = DEFAULT_PREDICT_THRESHOLD, tf: bool = False,
                     join_pairs: float | None = None) -> DataFrame:
    """Records -> pairs at or above the threshold in one pass: neither the rows
    of the other pairs nor their comparison vectors are ever written."""
    narrow = records.select(*[c for c in records.columns if not c.startswith("tf_")])
    pairs = reaching_pairs(narrow, params, settings, threshold, tf, join_pairs)
    gammas = comparisons.lean_gammas(comparisons.gamma_vectors(pairs, settings, keep_scores=False), settings)
    return score_stage(gammas, params, settings, threshold, tf)


def full_predictions(pairs: DataFrame, params: ParameterSet, settings: LinkSettings,
                     threshold: float | None = DEFAULT_PREDICT_THRESHOLD) -> DataFrame:
    """Predictions that retain every compared value and term frequency of both
    sides beside levels, factors, term adjustments, weight and probability
    (the lean stage keeps only what later stages read)."""
    pairs = scoring.may_reach(pairs, params, settings, threshold, tf_adjust=True)
    gammas = comparisons.gamma_vectors(pairs, settings, keep_scores=False)
    scored = scoring.score_pairs(gammas, params, settings, threshold=threshold, tf_adjust=True)
    uid, sides = settings.unique_id, ("_l", "_r")
    cols = [f"{uid}_l", f"{uid}_r", "match_key", "match_weight", "match_probability"]
    for comp in settings.comparisons:
        cols += [f"{comp.column}{s}" for s in sides] + [comp.gamma, scoring.bf_column(comp.column)]
        if comp.tf_adjust:
            cols += [f"tf_{comp.column}{s}" for s in sides] + [scoring.tf_adj_column(comp.column)]
    return scored.select(*cols)


def cluster_stage(predictions: DataFrame, latest: DataFrame,
                  threshold: float = DEFAULT_CLUSTER_THRESHOLD, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """(entity_clusters, match_edges) at the cluster threshold; ``written``:
    the predictions are the written edges of that threshold."""
    edges = predictions if written else materialize(scoring.edges_above(predictions, threshold), "match-edges")
    membership = graph.connected_components(edges)
    return graph.entity_clusters(membership, latest), edges


def run_linkage(spark: SparkSession, latest: DataFrame, settings: LinkSettings | None = None,
                params: ParameterSet | None = None, predict_threshold: float = DEFAULT_PREDICT_THRESHOLD,
                cluster_threshold: float = DEFAULT_CLUSTER_THRESHOLD, tf: bool = True,
                max_u_pairs: int | None = None) -> dict[str, DataFrame | ParameterSet]:
    """End-to-end: train (unless params given), predict, cluster."""
    settings = settings or LinkSettings()
    ensure_checkpoint_dir(spark)
    link_in = latest.where(F.col("name_norm").isNotNull())
    records = materialize(link_records(link_in, settings, tf=tf), "link-records")
    if params is None:
        params = model.train(records, settings, max_u_pairs, listed=True)
    predictions = materialize(prediction_stage(records, params, settings, predict_threshold, tf), "predictions")
    clusters, edges = cluster_stage(predictions, latest, cluster_threshold)
    return {"params": params, "predictions": predictions, "clusters": materialize(clusters, "entity-clusters"),
            "edges": edges, "records": records}
