"""Linkage settings: blocking rules, comparisons, training limits.

A plain immutable description; every operator takes it as an argument
(no global state)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Comparison:
    """One comparison column.

    ``kind='jaro_winkler'``: gamma = top level on equality, then one level
    per threshold (descending, ``>=``), 0 otherwise. ``kind='exact'``:
    gamma 1 on equality, 0 otherwise. Either side NULL -> gamma -1.
    """

    column: str
    kind: str = "exact"
    thresholds: tuple[float, ...] = ()
    tf_adjust: bool = False

    @property
    def exact_level(self) -> int:
        return len(self.thresholds) + 1

    @property
    def levels(self) -> list[int]:
        """Non-null gamma levels, highest first."""
        return list(range(self.exact_level, -1, -1))

    @property
    def gamma(self) -> str:
        return f"gamma_{self.column}"


# --- Fixed values (blocking rules and comparisons of the linkage) ---------
DEFAULT_BLOCKING_RULES: tuple[tuple[str, ...], ...] = (
    ("zip5", "name_first4"),
    ("name_norm",),
    ("cage_code",),
    ("zip5", "gov_poc_last"),
    ("entity_url",),
)
DEFAULT_COMPARISONS: tuple[Comparison, ...] = (
    Comparison("name_norm", "jaro_winkler", (0.92, 0.85, 0.7), tf_adjust=True),
    Comparison("dba_name", "jaro_winkler", (0.88,)),
    Comparison("phys_city", tf_adjust=True),
    Comparison("zip5", tf_adjust=True),
    Comparison("phys_state"),
    Comparison("entity_url"),
    Comparison("primary_naics"),
    Comparison("gov_poc_last", tf_adjust=True),
    Comparison("cage_code"),
    Comparison("entity_structure"),
)
DEFAULT_TRAINING_BLOCKS: tuple[tuple[str, ...], ...] = (("name_norm",), ("zip5", "phys_city"))
DEFAULT_PRIOR = 1e-4
DEFAULT_MAX_ITERATIONS = 20
DEFAULT_EM_CONVERGENCE = 1e-4
DEFAULT_U_MAX_PAIRS = 5_000_000
DEFAULT_PREDICT_THRESHOLD = 2.0
DEFAULT_CLUSTER_THRESHOLD = 5.0
# -------------------------------------------------------------------------


@dataclass(frozen=True)
class LinkSettings:
    unique_id: str = "uei"
    blocking_rules: tuple[tuple[str, ...], ...] = DEFAULT_BLOCKING_RULES
    comparisons: tuple[Comparison, ...] = DEFAULT_COMPARISONS
    prior: float = DEFAULT_PRIOR
    max_iterations: int = DEFAULT_MAX_ITERATIONS
    em_convergence: float = DEFAULT_EM_CONVERGENCE
    u_max_pairs: int = DEFAULT_U_MAX_PAIRS
    training_blocks: tuple[tuple[str, ...], ...] = DEFAULT_TRAINING_BLOCKS
    # A block with more rows than this is joined in cells of at most about
    # hot_block_rows^2 pairs each (4M at the default).
    hot_block_rows: int = 2_000
    seed: int = 42

    def comparison(self, column: str) -> Comparison:
        for c in self.comparisons:
            if c.column == column:
                return c
        raise KeyError(column)

    @property
    def compared_columns(self) -> list[str]:
        return [c.column for c in self.comparisons]

    @property
    def blocking_columns(self) -> list[str]:
        seen: list[str] = []
        for rule in self.blocking_rules + self.training_blocks:
            for c in rule:
                if c not in seen:
                    seen.append(c)
        return seen

    def record_columns(self) -> list[str]:
        cols = [self.unique_id]
        for c in self.compared_columns + self.blocking_columns:
            if c not in cols:
                cols.append(c)
        return cols
