"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, the separator of words in every operator here.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Below this many bytes a lookup table is broadcast; above, it is joined.
BROADCAST_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def broadcast_if_small(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast hint behind a check of the measured size."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_BYTES else df


def partitions_for(spark: SparkSession, total_bytes: float, target_bytes: int = 64 << 20) -> int:
    """Shuffle partitions so that one holds about ``target_bytes``, and never
    fewer than the session asks for."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(floor, math.ceil(total_bytes / target_bytes))
