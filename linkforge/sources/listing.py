"""Snapshot archive listings: which files to load, in which order, and
which are new.

A listing is a DataFrame ``(folder, name)``; on a real store it comes from
``archive_paths`` (the ``binaryFile`` source without its ``content`` column,
so no file body is read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text

# --- Fixed values --------------------------------------------------------
FOLDER_ORDER = ["Public V2", "Public - Historical"]
ARCHIVE_SUFFIXES = [".ZIP", ".zip"]   # matched case-sensitively, in this order
MONTHLY_MARKER = "V2"
SKIP_MARKER = "UTF-8"
# -------------------------------------------------------------------------


def with_folder_and_name(files: DataFrame) -> DataFrame:
    """Adds ``folder`` and ``name``, the last two parts of ``path``."""
    parts = F.split("path", "/")
    return files.withColumns({"folder": F.try_element_at(parts, F.lit(-2)), "name": F.element_at(parts, -1)})


def archive_paths(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, name) of every file under ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return with_folder_and_name(files.select("path"))


def snapshot_dates(listing: DataFrame) -> DataFrame:
    return listing.select("name", text.snapshot_date("name").alias("snapshot_date"))


def _ranks() -> dict[str, Column]:
    """Folder and suffix rank of a (folder, name); null where unknown."""
    folder_rank, suffix_rank = F.when(F.lit(False), 0), F.when(F.lit(False), 0)
    for i, f in enumerate(FOLDER_ORDER):
        folder_rank = folder_rank.when(F.col("folder") == f, i)
    for i, s in enumerate(ARCHIVE_SUFFIXES):
        suffix_rank = suffix_rank.when(F.col("name").endswith(s), i)
    return {"folder_rank": folder_rank, "suffix_rank": suffix_rank}


def load_ordered(archives: DataFrame) -> DataFrame:
    """Archives (path, ...) sorted into load order."""
    ranked = with_folder_and_name(archives).withColumns(_ranks())
    return ranked.orderBy(F.col("folder_rank").asc_nulls_last(), F.col("suffix_rank").asc_nulls_last(), "name")


def ordered_archives(listing: DataFrame) -> DataFrame:
    """Archives in load order (folder order, then ``.ZIP`` before ``.zip``,
    then name), names de-duplicated case-insensitively (first wins).
    Adds ``folder_rank``, ``suffix_rank`` and ``snapshot_date``."""
    ranked = listing.withColumns(_ranks()).where(F.col("folder_rank").isNotNull() & F.col("suffix_rank").isNotNull())
    # Partitioned by the lower-cased name: only same-name groups meet.
    first = Window.partitionBy(F.lower("name")).orderBy("folder_rank", "suffix_rank", "name")
    return (ranked.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")
                  .withColumn("snapshot_date", text.snapshot_date("name")))


def source_file_select(listing: DataFrame, mode: str = "all") -> DataFrame:
    """``all``: every archive without the UTF-8 marker, in load order.
    ``first``: the first monthly (V2) archive in load order, else the first
    archive (parity with the reference's default).
    ``latest``: the monthly archive with the greatest snapshot date."""
    ordered = ordered_archives(listing)
    order = ["folder_rank", "suffix_rank", "name"]
    if mode == "all":
        return ordered.where(~F.col("name").contains(SKIP_MARKER)).orderBy(*order)
    monthly = ordered.where(F.col("name").contains(MONTHLY_MARKER) & ~F.col("name").contains(SKIP_MARKER))
    if mode == "latest":
        return monthly.orderBy(F.col("snapshot_date").desc(), *order).limit(1)
    if mode == "first":
        pick = monthly.withColumn("_pref", F.lit(0)).unionByName(ordered.withColumn("_pref", F.lit(1)))
        return pick.orderBy("_pref", *order).limit(1).drop("_pref")
    raise ValueError(f"unknown mode {mode!r}")


def loaded_files(registrations: DataFrame) -> DataFrame:
    return registrations.select("source_file").distinct()


# Journal of loads: one row per archive that was read. An archive without rows
# is ``empty`` and is tried again; a ``loaded`` one is not, whatever became of
# its rows.
JOURNAL_SCHEMA = "name string, path string, size bigint, position bigint, status string, load bigint"


def pending_archives(selected: DataFrame, journal: DataFrame) -> DataFrame:
    """Selected archives that the journal doesn't name as loaded."""
    loaded = journal.where(F.col("status") == "loaded").select("name").distinct()
    return selected.join(loaded, "name", "left_anti")


def journal_after(journal: DataFrame, read: DataFrame) -> DataFrame:
    """The journal with the archives of one load: a name has one row, the last
    one written."""
    return journal.join(read.select("name"), "name", "left_anti").select(*journal.columns).unionByName(read)


def incremental_new_files(selected: DataFrame, registrations: DataFrame) -> DataFrame:
    """Selected archives whose name is not yet a ``source_file`` of the table."""
    loaded = loaded_files(registrations).withColumnRenamed("source_file", "name")
    return selected.join(loaded, "name", "left_anti")
