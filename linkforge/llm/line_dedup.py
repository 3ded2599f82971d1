"""Line dedup (operator 2): site-relative frequency.

A line is boilerplate of a host when it stands on more than ``ratio`` of the
host's pages and on at least ``min_pages`` of them (two, so that a page can't
be its own boilerplate). Boilerplate lines are dropped from the host's
pages; the other lines stay as they are, in order.

Lines are compared with white space at both ends removed; blank lines are
never boilerplate and always stay. A line counts once for a page however often
it stands there. With ``distinct_pages`` pages of a host that hold the same
lines in the same order count as one page, in a line's count and in the host's,
so that copies of a page can't make its own lines boilerplate.

Lines travel as 64-bit hashes. A wrong decision needs a line to collide with
one of the few boilerplate lines of its host (or two lines, each frequent, with
one another): with a thousand boilerplate lines a host that is 10^3 / 2^64 per
line, 5 * 10^-5 over 10^12 lines.

Everything is DataFrame functions. Counting is a map-side combined sum by
(host, line), so a line common to all pages shuffles once per task; so does a
page common to many rows where distinct pages are counted. A host's
boilerplate is a short list, bounded by its pages' mean number of lines over
``ratio``; the lists are joined to the pages by host, by broadcast where their
measured size is small, else by a shuffled join whose hot hosts AQE can split.

Edge cases: null text gives null text and no lines; null host is a host of its
own. Repeated rows are pages each unless distinct pages are counted. A page whose lines all go keeps its row with
an empty text. Extra columns are carried along; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CHARS, broadcast_if_small

RATIO = 0.1
MIN_PAGES = 2


def _lines(text_col: str) -> Column:
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)


def _hash(line: Column) -> Column:
    """Hash of the trimmed line, null for a blank one."""
    bare = F.btrim(line, F.lit(SPACE_CHARS))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source",
                text_col: str = "text", distinct_pages: bool = False) -> DataFrame:
    """host, line (hash), pages with it, pages of the host; boilerplate only."""
    hashes = F.filter(F.transform(_lines(text_col), _hash), lambda h: h.isNotNull())
    counted = pages.select(F.col(host_col).alias("host"), hashes.alias("lines"))
    if distinct_pages:
        counted = materialize(counted.distinct(), "distinct-pages")
    held = (counted.select("host", F.explode(F.array_distinct("lines")).alias("line"))
                   .groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")))
    total = counted.groupBy(F.col("host").alias("of_host")).agg(F.count(F.lit(1)).alias("host_pages"))
    return (held.where(F.col("pages") >= min_pages)
                .join(total, F.col("host").eqNullSafe(F.col("of_host")))
                .where(F.col("pages") > F.col("host_pages") * F.lit(ratio))
                .select("host", "line", "pages", "host_pages"))


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source",
                     text_col: str = "text", distinct_pages: bool = False) -> DataFrame:
    """The rows with their text cleaned, and n_lines and n_dropped (which
    replace columns of these names)."""
    added = ("n_lines", "n_dropped")
    others = [c for c in pages.columns if c not in (text_col, *added)]
    found = materialize(boilerplate(pages, ratio, min_pages, host_col, text_col, distinct_pages), "boilerplate")
    lists = found.groupBy(F.col("host").alias("boiler_host")).agg(F.collect_set("line").alias("boiler_lines"))
    lists = broadcast_if_small(lists, found.count(), 64)
    rows = pages.select(F.struct(*others).alias("row"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    lines = _lines("text")
    hits = F.array_intersect(F.transform(lines, _hash), F.coalesce("boiler_lines", F.array().cast("array<bigint>")))
    marked = (rows.join(lists, F.col("host").eqNullSafe(F.col("boiler_host")), "left")
                  .withColumn("hits", F.array_compact(hits)))
    none = F.size("hits") == 0

    def is_boiler(line: Column) -> Column:
        return F.coalesce(F.array_contains("hits", _hash(line)), F.lit(False))

    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    kept = F.when(none, F.col("text")).otherwise(F.concat_ws("\n", F.filter(lines, lambda x: ~is_boiler(x))))
    dropped = F.when(none, 0).otherwise(F.size(F.filter(lines, is_boiler)))
    clean = marked.select("row.*", kept.alias(text_col), n_lines.cast("long").alias("n_lines"),
                          dropped.cast("long").alias("n_dropped"))
    return clean.select(*(c for c in pages.columns if c not in added), *added)
