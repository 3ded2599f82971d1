"""Plan-shape guarantees the scale design relies on."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


def _plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_comparisons_use_arrow_python_only(spark):
    from linkforge.operators import blocking, comparisons
    from fixture_views import fixture_stages
    st = fixture_stages(spark, SF)
    pairs = blocking.candidate_pairs(st.records(True), st.settings)
    plan = _plan(spark, comparisons.gamma_vectors(pairs, st.settings))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_report_scan_pushes_filter(spark):
    plan = _plan(spark, entry.queries()["cluster_members"](spark, SF))
    assert "PushedFilters: [IsNotNull(cluster_id), EqualTo(cluster_id,0)]" in plan


def test_keep_last_aggregates_before_shuffle(spark):
    plan = _plan(spark, entry.queries()["dedupe_keep_last"](spark, SF))
    tree = plan.split("\n\n(1)")[0]
    # partial aggregate below the only exchange, final one above it
    lines = [ln.strip("+-: ") for ln in tree.splitlines()]
    ex = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange"))
    assert any("Aggregate" in ln for ln in lines[ex + 1:]) and any("Aggregate" in ln for ln in lines[:ex])
    assert "partial_max" in plan


def test_component_rounds_hash_aggregate(spark):
    from linkforge.operators import graph
    from linkforge.session import materialize
    e = materialize(spark.range(100).selectExpr("id + 1 AS a", "id AS b"), "plan-test-edges")
    tree = _plan(spark, graph._small_star(graph._large_star(e))).split("\n\n(1)")[0]
    assert "HashAggregate" in tree and "SortAggregate" not in tree
