"""Trigram index for the name search.

``postings``: for each trigram of a name and each block of ``BLOCK`` rows, the
sorted row numbers that hold it, as offsets in the block. A gram common to all
rows is one short list for each block, so no list grows with the table; Parquet
delta-codes the sorted offsets (``INDEX_OPTIONS``). ``rows``: the searched table
with its row numbers, sorted by them.

A search looks up the grams of the query's literal parts, intersects their
lists block by block, reads the rows of the numbers left and verifies them with
the same LIKE as a scan. So the answer is the scan's in every case: ``%`` and
``_`` in a query are wildcards and only cut it into literal parts; a query
without a literal part of three characters scans.

Edge cases: null names have no grams and match nothing; names shorter than
three characters have none either and can only match queries that scan. Rows
with the same key are rows each; an empty table gives empty postings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .explore import SEARCH_COLUMNS, name_match, search_clustered, search_registrations
from .graph import dense_ids

GRAM = 3
BLOCK = 1 << 16
# Grams looked up for one query: each more one narrows less and reads as much.
QUERY_GRAMS = 8
INDEX_OPTIONS = {"parquet.writer.version": "PARQUET_2_0"}
_WILDCARDS = re.compile(r"[%_]+")


def _grams(text: Column) -> Column:
    """The distinct trigrams of a text (null: none)."""
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))))


def numbered_rows(table: DataFrame, key: str = "uei") -> DataFrame:
    """The columns that a search reads, with dense row numbers in key order."""
    columns = [c for c in dict.fromkeys([*SEARCH_COLUMNS, "name_norm"]) if c in table.columns]
    return dense_ids(table.select(*columns), key, "row_no")


def postings(rows: DataFrame) -> DataFrame:
    """(gram, block, offsets): sorted offsets of the block's rows that hold the gram."""
    none = F.array().cast("array<string>")
    both = F.array_union(F.coalesce(_grams(F.col("name_norm")), none), F.coalesce(_grams(F.lower("legal_name")), none))
    held = rows.select(F.explode(both).alias("gram"), F.expr(f"row_no div {BLOCK}").alias("block"),
                       (F.col("row_no") % BLOCK).cast("int").alias("offset"))
    return held.groupBy("gram", "block").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))


def gram_counts(index: DataFrame) -> DataFrame:
    """(gram, n_rows): how many rows hold each gram."""
    return index.groupBy("gram").agg(F.sum(F.size("offsets").cast("long")).alias("n_rows"))


def query_grams(query: str) -> list[str]:
    """The trigrams that every match of the query holds."""
    parts = [p for p in _WILDCARDS.split(query)]
    return sorted({p[i:i + GRAM] for p in parts for i in range(len(p) - GRAM + 1)})


def candidate_rows(index: DataFrame, grams: list[str]) -> DataFrame:
    """row_no of the rows that hold all of ``grams``."""
    wanted = grams
    if len(grams) > QUERY_GRAMS:
        # One row for each gram of the query: the rarest ones are looked up.
        found = gram_counts(index.where(F.col("gram").isin(grams))).collect()
        sizes = {r["gram"]: r["n_rows"] for r in found}
        wanted = sorted(grams, key=lambda g: (sizes.get(g, 0), g))[:QUERY_GRAMS]
    # At most QUERY_GRAMS lists of at most BLOCK offsets meet in a row.
    lists = (index.where(F.col("gram").isin(wanted)).groupBy("block")
                  .agg(F.collect_list("offsets").alias("lists")).where(F.size("lists") == len(wanted)))
    common = F.reduce(F.slice("lists", 2, QUERY_GRAMS), F.element_at("lists", 1), F.array_intersect)
    return lists.select("block", F.explode(common).alias("offset")).select(
        (F.col("block") * BLOCK + F.col("offset")).alias("row_no"))


def candidates(rows: DataFrame, index: DataFrame, query: str) -> DataFrame:
    """The rows to verify: those that hold all trigrams of the query, or all
    rows where the query has none."""
    # Spark's lower(), as the match itself uses it.
    lowered = rows.sparkSession.range(1).select(F.lower(F.lit(query))).first()[0]
    grams = query_grams(lowered)
    if not grams:
        return rows
    return rows.join(candidate_rows(index, grams), "row_no", "left_semi")


def indexed_name_search(cluster_rows: DataFrame, cluster_index: DataFrame, latest_rows: DataFrame,
                        latest_index: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """``explore.name_search`` through the indexes of both tables: clustered
    matches, or matches among all registrations where there are none. The
    second index is read only then."""
    found = materialize(search_clustered(candidates(cluster_rows, cluster_index, query), query, limit), "search-hits")
    if not found.isEmpty():
        return found.orderBy(F.col("cluster_size").desc_nulls_last(), F.col("legal_name").asc_nulls_last(), F.col("uei"))
    return search_registrations(candidates(latest_rows, latest_index, query), query, limit)


def verified_rows(rows: DataFrame, index: DataFrame, query: str) -> DataFrame:
    """One row: how many rows the index hands on, how many of them match."""
    return candidates(rows, index, query).agg(
        F.count(F.lit(1)).alias("n_verified"),
        F.coalesce(F.sum(F.coalesce(name_match(query), F.lit(False)).cast("long")), F.lit(0)).alias("n_matches"))
