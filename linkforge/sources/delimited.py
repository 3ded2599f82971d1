"""Pipe-delimited snapshot records -> registration rows.

``parse_lines`` is the core: a DataFrame of ``(source_file, line_no, raw)``
becomes registration rows in ONE projection (split once, 32 positional
fields, trims, computed columns). Two readers feed it:

* ``read_text_lines``: already-unpacked ``.dat`` files through Spark's text
  source (splittable; ``lineSep='\\n'`` so a lone ``\\r`` inside a field does
  not split a record; bytes re-decoded as ISO-8859-1). ``line_no`` is made of
  the split's start and the row's position in it.
* ``read_zip_lines``: ZIP archives through the ``binaryFile`` source and a
  ``mapInArrow`` task per archive that streams the first ``.dat`` member in
  Arrow batches with exact line numbers (a ZIP is not splittable), followed
  by a repartition so parsing and everything after run wide.
"""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schema import MIN_FIELDS, REGISTRATION_COLUMNS, SOURCE_POSITIONS

LINE_SCHEMA = T.StructType([
    T.StructField("load_pos", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("raw", T.StringType()),
])
ARROW_BATCH_LINES = 20_000
LOAD_ORDER = ["load_pos", "path", "line_no"]


def parse_lines(lines: DataFrame, snapshot_from_name: bool = True) -> DataFrame:
    """Records with >= 122 fields, blank -> NULL, no key or '!end' key
    dropped, computed columns added. Columns in stored-table order, plus the
    keep-last order key (``load_pos``, ``path``, ``line_no``; lines without the
    first two count as one file).

    Field count and key are tested on the raw line (delimiters counted, text
    before the first one), so a line is split once, after the filters."""
    raw = F.rtrim(F.col("raw"), F.lit("\r\n"))       # strip trailing CR/LF (set trim, no regex)
    load_pos = F.col("load_pos") if "load_pos" in lines.columns else F.lit(0).cast("long").alias("load_pos")
    path = F.col("path") if "path" in lines.columns else F.col("source_file").alias("path")
    key = text.strip_ws(F.substring_index("raw", "|", 1))
    delimiters = F.length("raw") - F.length(F.replace(F.col("raw"), F.lit("|"), F.lit("")))
    kept = (lines.select(load_pos, path, "source_file", "line_no", raw.alias("raw"))
                 .where(~((F.col("line_no") == 0) & F.col("raw").startswith("BOF")))
                 .where((F.col("raw") != "") & ~F.col("raw").startswith("!end"))
                 .where((delimiters >= MIN_FIELDS - 1) & (key != "") & (key != "!end")))
    fielded = kept.withColumn("_f", F.split("raw", r"\|", -1))
    rows = fielded.select(
        *LOAD_ORDER, "source_file",
        *[text.blank_to_null(F.get(F.col("_f"), pos)).alias(name) for pos, name in SOURCE_POSITIONS])
    rows = (rows.withColumn("name_norm", text.normalize_name("legal_name"))
                .withColumn("zip5", text.zip5("phys_zip"))
                .withColumn("name_first4", text.first4("name_norm")))
    if snapshot_from_name:
        rows = rows.withColumn("snapshot_date", text.snapshot_date("source_file"))
    return rows.select(*REGISTRATION_COLUMNS, *LOAD_ORDER)


def _plain(path: str) -> str:
    path = path if "://" in path or path.startswith("file:") else os.path.abspath(path)
    return re.sub("^file:/+", "/", path)


def load_position(paths: Sequence[str]) -> Column:
    """Position of the ``path`` column in a list of paths (1, 2, ...; 0 for
    others). ``file:`` prefixes are spelt in several ways and don't count."""
    listed = F.array(*[F.lit(_plain(p)) for p in paths]) if paths else F.array().cast("array<string>")
    return F.array_position(listed, F.regexp_replace("path", "^file:/+", "/")).cast("long")


def read_text_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(load_pos, path, source_file, line_no, raw) from unpacked ``.dat``
    files. ``line_no`` orders lines within a file (block start, then position
    in the split); it is not the physical line number, so the header rule
    (line 0) is not applied -- the header fails the field-count check anyway."""
    df = spark.read.option("lineSep", "\n").text(paths)
    decoded = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    placed = df.select(
        path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("source_file"),
        (F.col("_metadata.file_block_start") * F.lit(1 << 24)
         + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("line_no"),
        decoded.alias("raw"))
    position = load_position(paths if isinstance(paths, list) else [paths])
    return placed.select(position.alias("load_pos"), *placed.columns)


def _unzip_batches(batches):
    """The lines of each archive's first ``.dat`` member (none: no lines)."""
    for batch in batches:
        for pos, path, body in zip(*(batch.column(c) for c in ("load_pos", "path", "content"))):
            # One archive body becomes Python bytes at a time (a task may hold
            # several archives; never copy them all at once).
            with zipfile.ZipFile(io.BytesIO(body.as_py())) as zf:
                members = [n for n in zf.namelist() if n.lower().endswith(".dat")]
                if members:
                    with zf.open(members[0]) as fh:
                        yield from _line_batches(fh, pos.as_py(), path.as_py())


def _line_batches(fh, load_pos: int, path: str):
    name, numbers, lines = path.rsplit("/", 1)[-1], [], []

    def rows() -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_pydict({"load_pos": [load_pos] * n, "path": [path] * n, "source_file": [name] * n,
                                           "line_no": numbers, "raw": lines})

    for i, raw in enumerate(fh):
        numbers.append(i)
        lines.append(raw.decode("latin-1"))
        if len(lines) >= ARROW_BATCH_LINES:
            yield rows()
            numbers, lines = [], []
    if lines:
        yield rows()


def unzip_lines(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """Lines of archives given as (load_pos, path, content): one task per
    archive for the unzip, then spread out."""
    lines = files.select("load_pos", "path", "content").mapInArrow(_unzip_batches, LINE_SCHEMA)
    return lines.repartition(partitions or files.sparkSession.sparkContext.defaultParallelism)


# Lines are spread so that a task gets about so many bytes of them; archives
# of such text shrink about eightfold.
LINE_BYTES_PER_TASK = 128 << 20
UNZIP_GROWTH = 8


def line_partitions(spark: SparkSession, archive_bytes: int) -> int:
    """Tasks for the lines of archives of so many bytes, as listed."""
    return max(spark.sparkContext.defaultParallelism, -(-archive_bytes * UNZIP_GROWTH // LINE_BYTES_PER_TASK))


def read_zip_lines(spark: SparkSession, paths: list[str] | str, partitions: int | None = None) -> DataFrame:
    """(load_pos, path, source_file, line_no, raw) from ZIP archives: those
    listed, in that order, whatever their names, or those of a folder."""
    files = spark.read.format("binaryFile")
    if isinstance(paths, str) and not paths.lower().endswith(".zip"):
        files = files.option("pathGlobFilter", "*.[zZ][iI][pP]")
    listed = [paths] if isinstance(paths, str) else paths
    return unzip_lines(files.load(listed).select(load_position(listed).alias("load_pos"), "path", "content"), partitions)


def registrations_with_sources(lines: DataFrame) -> DataFrame:
    """registrations_from_lines, and ``sources``: the load positions of all
    archives that had a row of the key, also those whose row was replaced."""
    from ..operators.tables import keep_last
    sources = F.collect_set("load_pos").alias("sources")
    return keep_last(parse_lines(lines), ["uei", "snapshot_date"], LOAD_ORDER, [sources]).drop(*LOAD_ORDER)


def registrations_from_lines(lines: DataFrame) -> DataFrame:
    """Parsed, keyed rows of one load: in-batch duplicates on
    (uei, snapshot_date) resolved keep-last by load order."""
    from ..operators.tables import keep_last
    return keep_last(parse_lines(lines), ["uei", "snapshot_date"], LOAD_ORDER).drop(*LOAD_ORDER)
