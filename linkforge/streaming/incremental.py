"""Incremental snapshot loading with Structured Streaming.

The archive folder is a file stream (``binaryFile`` source). Run with the
``availableNow`` trigger, every archive that arrived since the last run is
processed exactly once: the stream's checkpoint records which files were
consumed (the streaming form of "skip archives already loaded"). Each
micro-batch unpacks its archives, parses them, resolves in-batch duplicates
keep-last and upserts into the partitioned registrations table, rewriting
only the snapshot partitions it touches.

Archives are consumed in arrival (modification-time) order, one per
micro-batch by default, so a later archive's rows replace an earlier one's
for the same (uei, snapshot_date) -- the load order semantics of the batch
loader. Several archives of one micro-batch are taken in the batch loader's
order (folder, suffix, name).

The batch loader's selection holds here too: subfolders are read, UTF-8
variants are skipped, of names that differ only in case the first counts, and
an archive whose rows are stored already (by either loader) is not loaded
again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import tables
from ..session import path_exists
from ..sources import delimited, listing

ARCHIVE_GLOB = "*.[zZ][iI][pP]"
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def archive_stream(spark: SparkSession, source_dir: str, files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                 .option("pathGlobFilter", ARCHIVE_GLOB).option("recursiveFileLookup", "true")
                 .option("maxFilesPerTrigger", files_per_batch)
                 .load(source_dir))


def select_archives(spark: SparkSession, archives: DataFrame, table_path: str) -> list[str]:
    """Paths of a micro-batch's archives to load, in load order."""
    named = listing.with_folder_and_name(archives.select("path"))
    named = named.where(~F.col("name").contains(listing.SKIP_MARKER))
    if path_exists(spark, table_path):
        named = listing.incremental_new_files(named, spark.read.parquet(table_path))
    # One row per archive of the micro-batch (maxFilesPerTrigger).
    seen: dict[str, str] = {}
    for r in listing.load_ordered(named.select("path")).collect():
        seen.setdefault(r["name"].lower(), r["path"])
    return list(seen.values())


def _upsert_batch(table_path: str, on_loaded: Callable[[], None] | None):
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = select_archives(spark, batch, table_path)
        if not paths:
            return
        files = batch.withColumn("load_pos", delimited.load_position(paths)).where("load_pos > 0")
        rows = delimited.registrations_from_lines(delimited.unzip_lines(files))
        if tables.write_upsert(spark, rows, table_path) and on_loaded:
            on_loaded()
    return process


def run_stream(spark: SparkSession, source_dir: str, checkpoint_location: str, files_per_batch: int,
               process: Callable[[DataFrame, int], None]) -> int:
    """``process`` for each micro-batch of archives (path, modificationTime,
    length, content) that arrived since the last run; then stops. Returns the
    number of micro-batches. A batch whose ``process`` failed comes again."""
    query = (archive_stream(spark, source_dir, files_per_batch).writeStream
             .foreachBatch(process)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p.get("numInputRows", 0) > 0)


def incremental_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint_location: str,
                       files_per_batch: int = 1, on_loaded: Callable[[], None] | None = None) -> int:
    """Process every archive not seen before, then stop; ``on_loaded`` runs
    after each micro-batch that gave rows. Returns the number of micro-batches
    run. ``checkpoint_location`` must be on shared storage (it records which
    files the stream consumed)."""
    return run_stream(spark, source_dir, checkpoint_location, files_per_batch, _upsert_batch(table_path, on_loaded))
