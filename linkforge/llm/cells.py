"""Splitting large buckets of a bucketed self-join into cells of bounded size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small


def deal_cells(entries: DataFrame, bucket: str, ident: str, cell_rows: int, rows_per_group: int) -> DataFrame:
    """Adds ``part``, ``row``, ``col`` and ``group`` to the entries of a
    self-join on ``bucket``.

    A bucket of n entries has g = ceil(n / cell_rows) parts; its entries are
    dealt to parts by a hash of ``ident``. Cell (row, col), row <= col, holds
    parts ``row`` and ``col``: every two entries of the bucket meet in exactly
    one cell of distinct parts or in their own part's cell. An entry is copied
    g times (once where the bucket is small). Cells are dealt by hash into
    groups of about ``rows_per_group`` entries, and no fewer than four for
    each shuffle partition, for one task call each."""
    spark = entries.sparkSession
    large = (entries.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
                    .select(bucket, F.ceil(F.col("n") / F.lit(cell_rows)).cast("long").alias("parts")))
    total, n_large = entries.count(), large.count()
    extra = (large.agg(F.sum(F.col("parts") * F.col("parts") * cell_rows)).first()[0] or 0) if n_large else 0
    groups = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
                 math.ceil((total + extra) / rows_per_group))
    if n_large:
        parts = F.coalesce(F.col("parts"), F.lit(1).cast("long"))
        dealt = (entries.join(broadcast_if_small(large, n_large, 64), bucket, "left")
                        .withColumn("part", F.pmod(F.xxhash64(F.lit(7), ident), parts))
                        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts"))
    else:
        dealt = entries.withColumns({"part": F.lit(0).cast("long"), "other": F.lit(0).cast("long")})
    return (dealt.withColumns({"row": F.least("part", "other"), "col": F.greatest("part", "other")}).drop("other")
                 .withColumn("group", F.pmod(F.xxhash64(bucket, "row", "col"), F.lit(groups)).cast("long")))


class Forest:
    """Union-find over hashable ids; ``edges`` gives (id, smallest id) pairs."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def link(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple]:
        return [(x, self.find(x)) for x in list(self.parent) if self.find(x) != x]
