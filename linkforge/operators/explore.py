"""User-level queries over the cluster tables: name search, entity card,
cluster listing and diagnosis, statistics. Each returns a lazy DataFrame.

Orderings append the table key so results are deterministic, and sort
NULLs last. Top-k reports keep their limit (that is the feature); every
aggregate reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import like_pattern
from ..schema import ENTITY_CARD_FIELDS

# --- Fixed values: cluster size bands of the statistics report -----------
SIZE_BANDS = [(2, 2, "2"), (3, 5, "3-5"), (6, 10, "6-10"), (11, 20, "11-20"),
              (21, 50, "21-50"), (51, 100, "51-100")]
SIZE_BAND_ELSE = "100+"
# Largest cluster above this percentage of all entities suggests over-linking.
OVERLINK_PCT = 1.0
# -------------------------------------------------------------------------

SEARCH_COLUMNS = ["cluster_id", "cluster_size", "uei", "legal_name", "phys_city", "phys_state", "zip5"]


def name_match(query: str) -> Column:
    q = F.lit(query)
    return (F.like(F.col("name_norm"), like_pattern(F.lower(q)))
            | F.ilike(F.col("legal_name"), like_pattern(q)))


def search_clustered(clusters: DataFrame, query: str, limit: int = 25) -> DataFrame:
    return (clusters.where(name_match(query))
                    .orderBy(F.col("cluster_size").desc_nulls_last(), F.col("legal_name").asc_nulls_last(),
                             F.col("uei"))
                    .limit(limit)
                    .select(*SEARCH_COLUMNS))


def search_registrations(latest: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Fallback search over all latest registrations; cluster columns NULL."""
    return (latest.where(name_match(query))
                  .orderBy(F.col("legal_name").asc_nulls_last(), F.col("uei"))
                  .limit(limit)
                  .select(F.lit(None).cast("long").alias("cluster_id"),
                          F.lit(None).cast("long").alias("cluster_size"),
                          "uei", "legal_name", "phys_city", "phys_state", "zip5"))


def name_search(clusters: DataFrame, latest: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Clustered matches first; only when there are none, matches among all
    latest registrations. One plan: the fallback is gated by a scalar
    subquery (existence of any clustered match), evaluated once."""
    primary = search_clustered(clusters, query, limit)
    any_primary = clusters.where(name_match(query)).limit(1).agg(F.count(F.lit(1))).scalar()
    fallback = search_registrations(latest, query, limit).where(any_primary == F.lit(0))
    return primary.unionByName(fallback)


def entity_card(latest: DataFrame, uei: str) -> DataFrame:
    """(position, field, value) of the named fields that are present."""
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("field"),
                              F.col(name).cast("string").alias("value"))
                     for i, name in enumerate(ENTITY_CARD_FIELDS)])
    return (latest.where(F.col("uei") == F.lit(uei))
                  .select(F.inline(rows))
                  .where(F.col("value").isNotNull() & (F.col("value") != F.lit(""))))


def entity_cluster(clusters: DataFrame, uei: str) -> DataFrame:
    return clusters.where(F.col("uei") == F.lit(uei)).select("cluster_id", "cluster_size")


def cluster_members(clusters: DataFrame, cluster_id: int, limit: int = 50) -> DataFrame:
    return (clusters.where(F.col("cluster_id") == F.lit(cluster_id))
                    .orderBy(F.col("legal_name").asc_nulls_last(), F.col("uei"))
                    .limit(limit)
                    .select("uei", "legal_name", "phys_city", "phys_state", "zip5", "entity_url",
                            "cage_code", "cluster_size"))


def entity_members(clusters: DataFrame, uei: str, limit: int = 30) -> DataFrame:
    """The listing of the entity's cluster, itself included (the chained part
    of the entity card); no rows for an unclustered entity."""
    own = clusters.where(F.col("uei") == F.lit(uei)).select("cluster_id")
    return (clusters.join(own, "cluster_id", "left_semi")
                    .orderBy(F.col("legal_name").asc_nulls_last(), F.col("uei"))
                    .limit(limit)
                    .select("uei", "legal_name", "phys_city", "phys_state", "zip5", "entity_url",
                            "cage_code", "cluster_size"))


def cluster_size(clusters: DataFrame, cluster_id: int) -> DataFrame:
    """One row: the cluster and its number of members (0 if there is none)."""
    return (clusters.where(F.col("cluster_id") == F.lit(cluster_id))
                    .agg(F.count(F.lit(1)).alias("cluster_size"))
                    .select(F.lit(cluster_id).cast("long").alias("cluster_id"), "cluster_size"))


def _edges_in_cluster(edges: DataFrame, clusters: DataFrame, cluster_id: int) -> DataFrame:
    members = clusters.where(F.col("cluster_id") == F.lit(cluster_id)).select("uei")
    return (edges.join(members.withColumnRenamed("uei", "uei_l"), "uei_l", "left_semi")
                 .join(members.withColumnRenamed("uei", "uei_r"), "uei_r", "left_semi"))


def cluster_edges(edges: DataFrame, clusters: DataFrame, cluster_id: int, limit: int = 20) -> DataFrame:
    """Strongest edges inside a cluster, weight rounded to 1 dp."""
    return (_edges_in_cluster(edges, clusters, cluster_id)
            .orderBy(F.col("match_weight").desc(), "uei_l", "uei_r")
            .limit(limit)
            .select("uei_l", "uei_r", F.round("match_weight", 1).alias("weight")))


def weakest_edges(edges: DataFrame, clusters: DataFrame, latest: DataFrame, cluster_id: int,
                  limit: int = 15) -> DataFrame:
    """Weakest edges inside a cluster with names and cities of both ends."""
    attrs = latest.select("uei", "legal_name", "phys_city")
    left = attrs.select(F.col("uei").alias("uei_l"), F.col("legal_name").alias("name_l"),
                        F.col("phys_city").alias("city_l"))
    right = attrs.select(F.col("uei").alias("uei_r"), F.col("legal_name").alias("name_r"),
                         F.col("phys_city").alias("city_r"))
    return (_edges_in_cluster(edges, clusters, cluster_id)
            .join(left, "uei_l").join(right, "uei_r")
            .orderBy(F.col("match_weight").asc(), "uei_l", "uei_r")
            .limit(limit)
            .select("uei_l", "uei_r", F.round("match_weight", 2).alias("weight"),
                    "name_l", "name_r", "city_l", "city_r"))


def cluster_name_counts(clusters: DataFrame, cluster_id: int, n: int = 10) -> DataFrame:
    return (clusters.where(F.col("cluster_id") == F.lit(cluster_id))
                    .groupBy("name_norm").agg(F.count(F.lit(1)).alias("cnt"))
                    .orderBy(F.col("cnt").desc(), F.col("name_norm").asc_nulls_last())
                    .limit(n))


def cluster_city_counts(clusters: DataFrame, cluster_id: int, n: int = 10) -> DataFrame:
    return (clusters.where(F.col("cluster_id") == F.lit(cluster_id))
                    .groupBy("phys_city", "phys_state").agg(F.count(F.lit(1)).alias("cnt"))
                    .orderBy(F.col("cnt").desc(), F.col("phys_city").asc_nulls_last(),
                             F.col("phys_state").asc_nulls_last())
                    .limit(n))


def _pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), digits)


def cluster_stats(clusters: DataFrame, latest: DataFrame) -> DataFrame:
    """Totals: entities, clustered (+%), singletons (+%), clusters. The entity
    total comes in as a scalar subquery (no join)."""
    total = latest.agg(F.count(F.lit(1))).scalar()
    agg = clusters.agg(F.count_distinct("uei").alias("clustered"),
                       F.count_distinct("cluster_id").alias("n_clusters"))
    return agg.select(
        total.alias("total_entities"),
        F.col("clustered"),
        _pct(F.col("clustered"), total, 1).alias("clustered_pct"),
        (total - F.col("clustered")).alias("singletons"),
        _pct(total - F.col("clustered"), total, 1).alias("singletons_pct"),
        F.col("n_clusters"))


def size_band(col: str = "cluster_size") -> Column:
    c = F.col(col)
    e = None
    for lo, hi, label in SIZE_BANDS:
        cond = (c == lo) if lo == hi else c.between(lo, hi)
        e = F.when(cond, F.lit(label)) if e is None else e.when(cond, F.lit(label))
    return e.otherwise(F.lit(SIZE_BAND_ELSE))


def cluster_size_distribution(clusters: DataFrame) -> DataFrame:
    """Clusters and entities per size band, ordered by the smallest size in
    the band. Reduced to one row per cluster first (no distinct-expand)."""
    per_cluster = clusters.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("cluster_size").alias("size"))
    return (per_cluster.groupBy(size_band("size").alias("size_range"))
                       .agg(F.count(F.lit(1)).alias("n_clusters"),
                            F.sum("rows").cast("long").alias("n_entities"),
                            F.min("size").alias("min_size"))
                       .orderBy("min_size", "size_range")
                       .drop("min_size"))


def largest_clusters(clusters: DataFrame, n: int = 10) -> DataFrame:
    """Largest clusters with one example name/city/state each (independent
    minima, as in the report)."""
    return (clusters.groupBy("cluster_id", "cluster_size")
                    .agg(F.min("legal_name").alias("example_name"),
                         F.min("phys_city").alias("example_city"),
                         F.min("phys_state").alias("example_state"))
                    .orderBy(F.col("cluster_size").desc(), "cluster_id")
                    .limit(n))


def overlink_check(clusters: DataFrame, latest: DataFrame) -> DataFrame:
    """Largest cluster as a share of all entities; flag above 1 %."""
    total = latest.agg(F.count(F.lit(1))).scalar()
    return clusters.agg(F.max("cluster_size").alias("max_cluster_size")).select(
        "max_cluster_size", total.alias("total_entities"),
        _pct(F.col("max_cluster_size"), total, 2).alias("max_cluster_pct"),
        (F.col("max_cluster_size").cast("double") * 100.0 / total.cast("double")
         > F.lit(OVERLINK_PCT)).alias("overlink"))
