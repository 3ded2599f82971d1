"""Fellegi-Sunter parameters: prior match probability and, per comparison
and gamma level, m = P(level | match) and u = P(level | non-match).

The table has one row per (comparison, level) -- a few dozen rows whatever
the data size -- so it is held on the driver and compiled into literal
column expressions for scoring (no join)."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def level_params(levels: dict[str, dict[int, tuple[float, float]]]) -> dict[tuple[str, int], dict]:
    return {(c, g): {"m": m, "u": u} for c, lv in levels.items() for g, (m, u) in lv.items()}


@dataclass
class ParameterSet:
    prior: float
    # (column, gamma) -> {"m": float | None, "u": float | None}
    levels: dict[tuple[str, int], dict] = field(default_factory=dict)

    def m(self, column: str, gamma: int) -> float | None:
        return self.levels.get((column, gamma), {}).get("m")

    def u(self, column: str, gamma: int) -> float | None:
        return self.levels.get((column, gamma), {}).get("u")

    def log2_bf(self, column: str, gamma: int) -> float:
        m, u = self.m(column, gamma), self.u(column, gamma)
        if not m or not u:
            return 0.0
        return math.log2(m / u)

    @property
    def prior_weight(self) -> float:
        return math.log2(self.prior / (1.0 - self.prior))

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """Parameter summary: (comparison, gamma, m, u, log2_bayes_factor)."""
        schema = T.StructType([
            T.StructField("comparison", T.StringType()),
            T.StructField("gamma", T.IntegerType()),
            T.StructField("m_probability", T.DoubleType()),
            T.StructField("u_probability", T.DoubleType()),
            T.StructField("log2_bayes_factor", T.DoubleType()),
        ])
        rows = []
        for (c, g), v in sorted(self.levels.items(), key=lambda kv: (kv[0][0], -kv[0][1])):
            m, u = v.get("m"), v.get("u")
            bf = math.log2(m / u) if m and u else None
            rows.append((c, int(g), m, u, bf))
        return spark.createDataFrame(rows, schema)
