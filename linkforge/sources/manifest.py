"""Expected-vs-present reconciliation of snapshot files.

The expected side is a JSON listing document per folder
(``_embedded.customS3ObjectSummaryList[]`` of ``key, displayKey,
dateModified``); the present side is a file listing. Both are tables, so
the status of millions of files is one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values --------------------------------------------------------
KEY_PREFIX = "Entity Registration/"
# -------------------------------------------------------------------------

ENTRY = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("displayKey", T.StringType()),
    T.StructField("dateModified", T.StringType()),
])
LISTING_SCHEMA = T.StructType([
    T.StructField("_embedded", T.StructType([
        T.StructField("customS3ObjectSummaryList", T.ArrayType(ENTRY)),
    ])),
])


def listing_flatten(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """(folder, key, display_key, date_modified, local_path) per listed file."""
    parsed = docs.select("folder", F.from_json(json_col, LISTING_SCHEMA).alias("_doc"))
    items = parsed.select("folder", F.explode("_doc._embedded.customS3ObjectSummaryList").alias("_e"))
    return items.select(
        "folder", F.col("_e.key").alias("key"), F.col("_e.displayKey").alias("display_key"),
        F.col("_e.dateModified").alias("date_modified"),
        F.when(F.col("_e.key").startswith(KEY_PREFIX),
               F.expr(f"substring(_e.key, {len(KEY_PREFIX) + 1})"))
         .otherwise(F.col("_e.key")).alias("local_path"))


def _present_keyed(present: DataFrame) -> DataFrame:
    """One row per case-folded name (names differing only in case are one
    file on a case-insensitive store; the larger size is kept)."""
    return present.groupBy(F.lower("name").alias("_lname")).agg(F.max("size_bytes").alias("size_bytes"))


def manifest_status(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Each expected file marked downloaded or missing (case-insensitive name
    match), with its size in MB."""
    joined = expected.withColumn("_lname", F.lower("display_key")).join(
        _present_keyed(present), "_lname", "left")
    return joined.select(
        "folder", F.col("display_key").alias("name"), "date_modified",
        F.col("size_bytes").isNotNull().alias("downloaded"),
        F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 1).alias("size_mb"))


def manifest_progress(status: DataFrame) -> DataFrame:
    """done / total per folder."""
    return status.groupBy("folder").agg(F.sum(F.col("downloaded").cast("long")).alias("done"),
                                        F.count(F.lit(1)).alias("total"))


def manifest_missing(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files with no present copy."""
    return (expected.withColumn("_lname", F.lower("display_key"))
                    .join(_present_keyed(present), "_lname", "left_anti")
                    .select("folder", "key", F.col("display_key").alias("name")))
