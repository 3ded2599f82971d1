"""Registration tables: in-batch dedupe, keyed upsert, latest row per key,
history lists and ingest summaries.

"Keep the last row per key" is a ``max`` over a struct whose first field
is the order key: an aggregate with a map-side partial step, so a key that
holds a large share of the rows is reduced in every map task before the
shuffle (a window would pull the whole group into one task and sort it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REGISTRATION_COLUMNS
from ..session import materialize, path_exists


def keep_last(df: DataFrame, keys: list[str], order: list[str], also: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple. ``also``:
    named aggregates over all rows of the key."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*others).alias("_row"))
    found = df.groupBy(*keys).agg(F.max(packed).alias("_best"), *also)
    added = [c for c in found.columns if c not in keys and c != "_best"]
    return found.select(*keys, "_best._row.*", *added).select(*df.columns, *added)


def dedupe_keep_last(df: DataFrame, keys=("uei", "snapshot_date"), order_col: str = "line_no") -> DataFrame:
    """In-batch dedupe on the key, keeping the last row in file order."""
    return keep_last(df, list(keys), [order_col])


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys=("uei", "snapshot_date")) -> DataFrame:
    """Existing rows replaced by incoming rows with the same key."""
    cols = existing.columns
    tagged = (existing.select(*cols, F.lit(0).alias("_load_seq"))
              .unionByName(incoming.select(*cols, F.lit(1).alias("_load_seq"))))
    return keep_last(tagged, list(keys), ["_load_seq"]).drop("_load_seq")


def write_upsert(spark: SparkSession, incoming: DataFrame, path: str,
                 keys=("uei", "snapshot_date"), partition_col: str = "snapshot_date") -> int:
    """Upsert into a Parquet table partitioned by ``partition_col``; returns
    the number of incoming rows. Only the partitions the batch touches are
    read, merged and rewritten (dynamic partition overwrite, asked for by a
    write option). Incoming and merged rows are stage tables: the batch is
    evaluated once, and the job never reads the files it replaces. A table
    that is there but can't be read is an error, never a first load."""
    incoming = materialize(incoming, "upsert-incoming")
    rows = incoming.count()
    if not rows:
        return 0
    merged = incoming
    if path_exists(spark, path):
        touched = incoming.select(partition_col).distinct()
        current = spark.read.parquet(path).join(touched, partition_col, "left_semi").select(*incoming.columns)
        merged = materialize(upsert_by_key(current, incoming, keys), "upsert-merge")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(path))
    return rows


def latest_per_key(registrations: DataFrame, key: str = "uei", date_col: str = "snapshot_date") -> DataFrame:
    """The row of each key with the greatest snapshot date."""
    return keep_last(registrations, [key], [date_col])


def history_names(registrations: DataFrame, key: str = "uei", name_col: str = "name_norm") -> DataFrame:
    """Distinct non-null names per key, as a sorted list. ``collect_set``
    de-duplicates in its map-side partial step: one shuffle."""
    return (registrations.where(F.col(name_col).isNotNull())
                         .groupBy(key).agg(F.array_sort(F.collect_set(name_col)).alias("all_names")))


def history_locations(registrations: DataFrame, key: str = "uei") -> DataFrame:
    """Distinct ``city|zip5`` per key (rows with a zip5), sorted, with one
    NULL element kept at the end when some row has no city."""
    loc = F.concat(F.col("phys_city"), F.lit("|"), F.col("zip5"))
    rows = registrations.where(F.col("zip5").isNotNull()).select(key, loc.alias("loc"))
    agg = rows.groupBy(key).agg(F.array_sort(F.collect_set("loc")).alias("_vals"),
                                F.max(F.col("loc").isNull().cast("int")).alias("_has_null"))
    return agg.select(key, F.when(F.col("_has_null") == 1,
                                  F.concat("_vals", F.array(F.lit(None).cast("string"))))
                      .otherwise(F.col("_vals")).alias("all_locations"))


def refresh_keys(derived: DataFrame, rebuilt: DataFrame, touched: DataFrame, key: str = "uei") -> DataFrame:
    """A table of one row per key after some keys changed: ``derived`` without
    the ``touched`` keys, and ``rebuilt``, their rows computed anew (a key may
    have none any more)."""
    return derived.join(touched.select(key), key, "left_anti").select(*derived.columns).unionByName(rebuilt)


def refresh_latest(derived: DataFrame, registrations: DataFrame, touched: DataFrame) -> DataFrame:
    """``latest_per_key`` brought up to date for the touched keys."""
    return refresh_keys(derived, latest_per_key(_of(registrations, touched)), touched)


def refresh_names(derived: DataFrame, registrations: DataFrame, touched: DataFrame) -> DataFrame:
    """``history_names`` brought up to date for the touched keys."""
    return refresh_keys(derived, history_names(_of(registrations, touched)), touched)


def refresh_locations(derived: DataFrame, registrations: DataFrame, touched: DataFrame) -> DataFrame:
    """``history_locations`` brought up to date for the touched keys."""
    return refresh_keys(derived, history_locations(_of(registrations, touched)), touched)


def _of(registrations: DataFrame, touched: DataFrame, key: str = "uei") -> DataFrame:
    return registrations.join(touched.select(key), key, "left_semi").select(*registrations.columns)


def ingest_counts(registrations: DataFrame, key: str = "uei", date_col: str = "snapshot_date") -> DataFrame:
    """Total rows, distinct snapshots, distinct keys: each distinct count is
    an aggregation of one column (no Expand over the table)."""
    def distinct(col: str):
        return registrations.where(F.col(col).isNotNull()).select(col).distinct().agg(F.count(F.lit(1))).scalar()

    return registrations.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", distinct(date_col).alias("snapshots"), distinct(key).alias("unique_ueis"))


def sample_latest(latest: DataFrame, n: int = 5, name_col: str = "legal_name",
                  columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` latest rows by name (NULLs last, key as tie-break)."""
    cols = columns or ["uei", name_col, "phys_city", "phys_state", "zip5", "snapshot_date"]
    return latest.orderBy(F.col(name_col).asc_nulls_last(), F.col("uei")).limit(n).select(*cols)


def align_to_schema(df: DataFrame, columns: list[str] = REGISTRATION_COLUMNS) -> DataFrame:
    """Column order of the stored table (missing columns as NULL strings)."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in columns])
