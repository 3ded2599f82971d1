"""

``entry(spark)``      flagship query on sf0.001: connected components of the
                      scored entity graph, reported as cluster statistics.
                      each (spark, sf_dir) -> DataFrame over the whole tables.
``oracle_sql()``      DuckDB SQL for each key that has a SQL equivalent.

Keys on the entity view E (planted near-duplicates over ``part``) share one
materialised linkage per session (see ``linkforge.plans.linkage``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkforge.operators import blocking, comparisons, explore, graph, model, scoring, search_index, tables  # noqa: E402
import fixture_views as fixtures  # noqa: E402
from linkforge.plans import linkage  # noqa: E402
from linkforge.sources import delimited, html_links, listing, manifest, pages  # noqa: E402
from linkforge.schema import LINK_COLUMNS  # noqa: E402
from linkforge.session import materialize  # noqa: E402
from linkforge.settings import LinkSettings  # noqa: E402

try:
    from linkforge.llm import queries as llm_queries  # noqa: E402
except ImportError as missing:  # the subpackage may be left out, or lack a library of its own
    if (missing.name or "").startswith("linkforge.") and missing.name.split(".")[1] != "llm":
        raise
    llm_queries = None

SMALL_U_SAMPLE = 5_000
SMALL_BLOCK_ROWS = 3
FLAGSHIP_SF = "/root/testdata/sf0.001"
SETTINGS = LinkSettings()
GAMMAS = [c.gamma for c in SETTINGS.comparisons]


def _st(spark: SparkSession, sf_dir: str) -> fixtures.FixtureStages:
    return fixtures.fixture_stages(spark, sf_dir)


def _r6(c: str) -> F.Column:
    return F.round(c, 6).alias(c)


def entry(spark: SparkSession) -> DataFrame:
    st = _st(spark, FLAGSHIP_SF)
    return explore.cluster_stats(st.clusters(), st.latest())


# ----------------------------------------------------------- link keys ----

def q_normalize_names(spark, d):
    return _st(spark, d).latest().select("uei", "legal_name", "name_norm")


def q_blocking_keys(spark, d):
    return _st(spark, d).latest().select("uei", "zip5", "name_first4")


def q_link_input(spark, d):
    return fixtures.link_input(spark, d).select(*LINK_COLUMNS)


def q_candidate_pairs(spark, d):
    return _st(spark, d).pairs().select("uei_l", "uei_r", "match_key")


def q_candidate_pairs_hot_blocks(spark, d):
    """The same pairs with nearly every block joined in cells."""
    pairs = blocking.candidate_pairs(_st(spark, d).records(), SETTINGS, carry=[], hot_block_rows=SMALL_BLOCK_ROWS)
    return pairs.select("uei_l", "uei_r", "match_key")


def q_naive_pair_count(spark, d):
    return blocking.naive_pair_count(_st(spark, d).records())


def q_blocking_rule_counts(spark, d):
    return blocking.blocking_rule_counts(_st(spark, d).pairs())


def q_jaro_winkler(spark, d):
    return comparisons.jaro_winkler_pairs(_st(spark, d).pairs(), "name_norm")


def q_gamma_vectors(spark, d):
    return _st(spark, d).gammas().select("uei_l", "uei_r", *GAMMAS)


def q_gamma_patterns(spark, d):
    return comparisons.gamma_patterns(_st(spark, d).gammas(), SETTINGS)


def q_term_frequencies(spark, d):
    recs = _st(spark, d).records()
    parts = [model.term_frequencies(recs, c.column).select(F.lit(c.column).alias("comparison"), "*")
             for c in SETTINGS.comparisons if c.tf_adjust]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scored_out(df):
    return df.select("uei_l", "uei_r", "match_key", _r6("match_weight"), _r6("match_probability"))


def q_score_pairs(spark, d):
    return _scored_out(_st(spark, d).scoring_pass(2.0))


def q_score_pairs_tf(spark, d):
    return _scored_out(_st(spark, d).scoring_pass(2.0, tf=True))


def q_weight_bands(spark, d):
    return scoring.weight_bands(_st(spark, d).scoring_pass(2.0))


def q_top_pairs(spark, d):
    return scoring.top_pairs(_st(spark, d).scoring_pass(2.0), 10)


def q_edge_threshold(spark, d):
    return _st(spark, d).edges().select("uei_l", "uei_r", _r6("match_weight"), _r6("match_probability"))


def q_graph_nodes(spark, d):
    return graph.graph_nodes(_st(spark, d).edges())


def q_connected_components(spark, d):
    return _st(spark, d).clusters().select("cluster_id", "uei", "cluster_size")


def q_connected_components_incremental(spark, d):
    """Labels of every second scored pair brought up to date for the edges:
    pairs come in and, where they score too low, go."""
    st = _st(spark, d)
    start = st.predictions(2.0).where(F.crc32(F.concat("uei_l", "uei_r")) % 2 == 0).select("uei_l", "uei_r")
    labels = graph.change_edges(materialize(graph.component_labels(start), "start-labels"), start, st.edges())
    return graph.numbered_components(labels).select("cluster_id", "uei", "cluster_size")


def q_entity_clusters(spark, d):
    return _st(spark, d).clusters()


def q_cluster_stats(spark, d):
    st = _st(spark, d)
    return explore.cluster_stats(st.clusters(), st.latest())


def q_cluster_size_distribution(spark, d):
    return explore.cluster_size_distribution(_st(spark, d).clusters())


def q_largest_clusters(spark, d):
    return explore.largest_clusters(_st(spark, d).clusters(), 10)


def q_overlink_check(spark, d):
    st = _st(spark, d)
    return explore.overlink_check(st.clusters(), st.latest())


def q_cluster_members(spark, d):
    return explore.cluster_members(_st(spark, d).clusters(), 0, 50)


def q_cluster_edges(spark, d):
    st = _st(spark, d)
    return explore.cluster_edges(st.edges(), st.clusters(), 0, 20)


def q_weakest_edges(spark, d):
    st = _st(spark, d)
    return explore.weakest_edges(st.edges(), st.clusters(), st.latest(), 0, 15)


def q_cluster_name_counts(spark, d):
    return explore.cluster_name_counts(_st(spark, d).clusters(), 0, 10)


def q_cluster_city_counts(spark, d):
    return explore.cluster_city_counts(_st(spark, d).clusters(), 0, 10)


def q_entity_lookup(spark, d):
    return explore.entity_card(_st(spark, d).latest(), "000000000004")


def q_entity_cluster(spark, d):
    return explore.entity_cluster(_st(spark, d).clusters(), "000000000004")


def q_entity_members(spark, d):
    return explore.entity_members(_st(spark, d).clusters(), "000000000004", 30)


def q_diagnosed_size(spark, d):
    return explore.cluster_size(_st(spark, d).clusters(), 0)


def _unclustered_name(st):
    alone = st.latest().where(F.col("legal_name").isNotNull()).join(st.clusters().select("uei"), "uei", "left_anti")
    return alone.agg(F.min_by("legal_name", "uei")).first()[0] or ""


def q_name_search_unclustered(spark, d):
    """Search for the name of the first entity outside all clusters: where no
    clustered entity matches it, the search falls back to all registrations."""
    st = _st(spark, d)
    return explore.name_search(st.clusters(), st.latest(), _unclustered_name(st), 25)


def _indexed(st):
    return [part for table in (st.clusters(), st.latest()) for part in st.search_index(table)]


def q_name_search_indexed(spark, d):
    """The name search through trigram postings of both tables."""
    return search_index.indexed_name_search(*_indexed(_st(spark, d)), "ring", 25)


def q_name_search_unclustered_indexed(spark, d):
    st = _st(spark, d)
    return search_index.indexed_name_search(*_indexed(st), _unclustered_name(st), 25)


def q_search_gram_counts(spark, d):
    """How many entities each indexed trigram leads to."""
    st = _st(spark, d)
    return search_index.gram_counts(st.search_index(st.latest())[1])


def q_predictions_full(spark, d):
    """Predictions with every compared value, term frequency, level and factor."""
    st = _st(spark, d)
    full = linkage.full_predictions(st.reaching(2.0), fixtures.fixed_parameters(), SETTINGS, 2.0)
    return full.select(*[_r6(c) if c.startswith(("bf_", "tf_", "match_w", "match_p")) else c for c in full.columns])


def q_name_search(spark, d):
    st = _st(spark, d)
    return explore.name_search(st.clusters(), st.latest(), "ring", 25)


def q_name_search_fallback(spark, d):
    return explore.search_registrations(_st(spark, d).latest(), "gizmo", 25)


# ---------------------------------------------------------- model keys ----

def q_u_estimates(spark, d):
    return model.u_estimates(_st(spark, d).records(), SETTINGS)


def q_u_estimates_small_sample(spark, d):
    """A sample far below all pairs, so that slots are cut off."""
    return model.u_estimates(_st(spark, d).records(), SETTINGS, max_pairs=SMALL_U_SAMPLE)


def q_em_one_step(spark, d):
    patterns = comparisons.gamma_patterns(_st(spark, d).gammas(), SETTINGS)
    step = model.em_one_step_frame(patterns, fixtures.fixed_parameters(), SETTINGS)
    return step.select("comparison", "gamma", _r6("m_probability"), _r6("match_share"))


def q_match_weight_table(spark, d):
    """Parameters trained on E (u by random pairs, two EM passes)."""
    params = model.train(_st(spark, d).records(), SETTINGS)
    return params.to_dataframe(spark).select("comparison", "gamma", *[
        _r6(c) for c in ("m_probability", "u_probability", "log2_bayes_factor")])


def q_trained_cluster_stats(spark, d):
    """Full run: train, predict at 2.0, cluster at 5.0, report."""
    st = _st(spark, d)
    out = linkage.run_linkage(spark, st.latest(), SETTINGS, tf=True)
    return explore.cluster_stats(out["clusters"], st.latest())


# --------------------------------------------------------- ingest keys ----

def _registrations(spark, d):
    return tables.dedupe_keep_last(fixtures.history_view(spark, d))


def q_dedupe_keep_last(spark, d):
    return _registrations(spark, d)


def q_upsert_by_key(spark, d):
    h = fixtures.history_view(spark, d)
    stored = tables.dedupe_keep_last(h.where(F.col("line_no") % 2 == 0))
    incoming = tables.dedupe_keep_last(h.where(F.col("line_no") % 2 == 1))
    return tables.upsert_by_key(stored, incoming)


def q_latest_per_key(spark, d):
    return tables.latest_per_key(_registrations(spark, d))


def q_history_names(spark, d):
    return tables.history_names(_registrations(spark, d))


def q_history_locations(spark, d):
    return tables.history_locations(_registrations(spark, d))


def _two_loads(spark, d):
    """History after a first load, after a second one, and the second's ueis."""
    h = fixtures.history_view(spark, d)
    first = tables.dedupe_keep_last(h.where(F.col("line_no") % 3 != 1))
    second = tables.dedupe_keep_last(h.where(F.col("line_no") % 3 == 1))
    return first, tables.dedupe_keep_last(h), second.select("uei").distinct()


def q_latest_per_key_incremental(spark, d):
    """Latest rows after a load, brought up to date for the ueis of the next."""
    before, after, touched = _two_loads(spark, d)
    return tables.refresh_latest(tables.latest_per_key(before), after, touched)


def q_history_names_incremental(spark, d):
    before, after, touched = _two_loads(spark, d)
    return tables.refresh_names(tables.history_names(before), after, touched)


def q_history_locations_incremental(spark, d):
    before, after, touched = _two_loads(spark, d)
    return tables.refresh_locations(tables.history_locations(before), after, touched)


def q_sample_latest(spark, d):
    return tables.sample_latest(tables.latest_per_key(_registrations(spark, d)), 5, name_col="name_norm",
                                columns=["uei", "name_norm", "phys_city", "zip5", "snapshot_date"])


def q_ingest_counts(spark, d):
    return tables.ingest_counts(_registrations(spark, d))


def q_scan_delimited(spark, d):
    return delimited.registrations_from_lines(fixtures.customer_lines(spark, d))


def q_scan_archives(spark, d):
    """Archives as bytes: unzip, Latin-1, line ends, keep-last across files."""
    files = fixtures.customer_archives(spark, d)
    return delimited.registrations_from_lines(delimited.unzip_lines(files))


def q_snapshot_dates(spark, d):
    return listing.snapshot_dates(fixtures.archive_listing(spark, d))


def _selected(df):
    return df.select("folder", "name", "snapshot_date")


def q_source_file_select(spark, d):
    return _selected(listing.source_file_select(fixtures.archive_listing(spark, d), "all"))


def q_source_file_first(spark, d):
    return _selected(listing.source_file_select(fixtures.archive_listing(spark, d), "first"))


def q_source_file_latest(spark, d):
    return _selected(listing.source_file_select(fixtures.archive_listing(spark, d), "latest"))


def q_incremental_new_files(spark, d):
    selected = listing.source_file_select(fixtures.archive_listing(spark, d), "all")
    return _selected(listing.incremental_new_files(selected, fixtures.loaded_registrations(spark, d)))


def q_pending_archives(spark, d):
    """Archives that a load journal doesn't name as loaded."""
    selected = listing.source_file_select(fixtures.archive_listing(spark, d), "all")
    return _selected(listing.pending_archives(selected, fixtures.load_journal(spark, d)))


def _expected(spark, d):
    return manifest.listing_flatten(fixtures.listing_documents(spark, d))


def q_listing_flatten(spark, d):
    return _expected(spark, d)


def q_manifest_status(spark, d):
    return manifest.manifest_status(_expected(spark, d), fixtures.present_files(spark, d))


def q_manifest_progress(spark, d):
    return manifest.manifest_progress(q_manifest_status(spark, d))


def q_manifest_missing(spark, d):
    return manifest.manifest_missing(_expected(spark, d), fixtures.present_files(spark, d))


def q_page_links(spark, d):
    return pages.page_links(fixtures.read_table(spark, d, "pages"), css_class=None)


def q_page_links_class(spark, d):
    return pages.page_links(fixtures.class_pages(spark, d))


def q_page_links_parsed(spark, d):
    """The same anchors by the tokeniser with an open-element stack."""
    return html_links.page_links(fixtures.read_table(spark, d, "pages"), css_class=None)


def q_page_links_broken(spark, d):
    """Pages with comments, scripts, stray and missing end tags around theirs."""
    return html_links.page_links(fixtures.broken_pages(spark, d), css_class=None)


def q_page_link_counts(spark, d):
    return pages.page_link_counts(q_page_links(spark, d))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_names": q_normalize_names,
    "blocking_keys": q_blocking_keys,
    "link_input": q_link_input,
    "candidate_pairs": q_candidate_pairs,
    "candidate_pairs_hot_blocks": q_candidate_pairs_hot_blocks,
    "blocking_rule_counts": q_blocking_rule_counts,
    "naive_pair_count": q_naive_pair_count,
    "jaro_winkler": q_jaro_winkler,
    "gamma_vectors": q_gamma_vectors,
    "gamma_patterns": q_gamma_patterns,
    "term_frequencies": q_term_frequencies,
    "score_pairs": q_score_pairs,
    "score_pairs_tf": q_score_pairs_tf,
    "weight_bands": q_weight_bands,
    "top_pairs": q_top_pairs,
    "edge_threshold": q_edge_threshold,
    "graph_nodes": q_graph_nodes,
    "connected_components": q_connected_components,
    "connected_components_incremental": q_connected_components_incremental,
    "entity_clusters": q_entity_clusters,
    "cluster_stats": q_cluster_stats,
    "cluster_size_distribution": q_cluster_size_distribution,
    "largest_clusters": q_largest_clusters,
    "overlink_check": q_overlink_check,
    "cluster_members": q_cluster_members,
    "cluster_edges": q_cluster_edges,
    "weakest_edges": q_weakest_edges,
    "cluster_name_counts": q_cluster_name_counts,
    "cluster_city_counts": q_cluster_city_counts,
    "entity_lookup": q_entity_lookup,
    "entity_cluster": q_entity_cluster,
    "entity_members": q_entity_members,
    "diagnosed_size": q_diagnosed_size,
    "name_search_unclustered": q_name_search_unclustered,
    "name_search_indexed": q_name_search_indexed,
    "name_search_unclustered_indexed": q_name_search_unclustered_indexed,
    "search_gram_counts": q_search_gram_counts,
    "predictions_full": q_predictions_full,
    "name_search": q_name_search,
    "name_search_fallback": q_name_search_fallback,
    "u_estimates": q_u_estimates,
    "u_estimates_small_sample": q_u_estimates_small_sample,
    "em_one_step": q_em_one_step,
    "match_weight_table": q_match_weight_table,
    "trained_cluster_stats": q_trained_cluster_stats,
    "dedupe_keep_last": q_dedupe_keep_last,
    "upsert_by_key": q_upsert_by_key,
    "latest_per_key": q_latest_per_key,
    "history_names": q_history_names,
    "history_locations": q_history_locations,
    "latest_per_key_incremental": q_latest_per_key_incremental,
    "history_names_incremental": q_history_names_incremental,
    "history_locations_incremental": q_history_locations_incremental,
    "sample_latest": q_sample_latest,
    "ingest_counts": q_ingest_counts,
    "scan_delimited": q_scan_delimited,
    "scan_archives": q_scan_archives,
    "snapshot_dates": q_snapshot_dates,
    "source_file_select": q_source_file_select,
    "source_file_first": q_source_file_first,
    "source_file_latest": q_source_file_latest,
    "incremental_new_files": q_incremental_new_files,
    "pending_archives": q_pending_archives,
    "listing_flatten": q_listing_flatten,
    "manifest_status": q_manifest_status,
    "manifest_progress": q_manifest_progress,
    "manifest_missing": q_manifest_missing,
    "page_links": q_page_links,
    "page_links_class": q_page_links_class,
    "page_links_parsed": q_page_links_parsed,
    "page_links_broken": q_page_links_broken,
    "page_link_counts": q_page_link_counts,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | (llm_queries.QUERIES if llm_queries else {})


def oracle_sql() -> dict[str, str]:
    import duckdb_oracle
    out = {}
    out.update(duckdb_oracle.link_queries())
    out.update(duckdb_oracle.ingest_queries())
    out.update(duckdb_oracle.model_queries())
    if llm_queries:
        out.update(llm_queries.ORACLES)
    return {k: v for k, v in out.items() if k in queries()}
