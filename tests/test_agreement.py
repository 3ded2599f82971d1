import random

import pytest
from pyspark.sql import functions as F

import fixture_views as fixtures
from linkforge.operators import agreement, blocking, comparisons, graph, model, scoring
from linkforge.plans import linkage
from linkforge.settings import LinkSettings

SET = LinkSettings()
PARAMS = fixtures.fixed_parameters()


def _records(spark, n, seed, nulls=0.1, names=3):
    rnd = random.Random(seed)
    kinds = {"name_norm": names, "dba_name": 3, "phys_city": 4, "zip5": 6, "phys_state": 3, "entity_url": 40,
             "primary_naics": 5, "gov_poc_last": 12, "cage_code": 20, "entity_structure": 4}
    rows = []
    for i in range(n):
        v = [None if rnd.random() < nulls and c != "name_norm" else f"{c[:3]} {'abcdefgh'[rnd.randrange(k) % 8]}{rnd.randrange(k)}"
             for c, k in kinds.items()]
        if i % 3 and rows:  # a near copy
            v = [a if rnd.random() < 0.3 else b for a, b in zip(v, rnd.choice(rows)[1:-1])]
        rows.append((f"{i:06d}", *v, v[0][:4]))
    rows += rows[:5]  # rows that come twice
    recs = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["uei", *kinds, "name_first4"]))
    return model.with_term_frequencies(recs, SET).localCheckpoint()


def _found(df):
    rows = df.select("uei_l", "uei_r", "match_key", F.round("match_weight", 6).alias("w")).collect()
    return sorted((r.uei_l, r.uei_r, r.match_key, r.w) for r in rows)


@pytest.mark.parametrize("nulls", [0.0, 0.2])
def test_finer_joins_lose_no_prediction(spark, nulls):
    recs = _records(spark, 150, 5, nulls)
    gammas = comparisons.lean_gammas(comparisons.gamma_vectors(blocking.candidate_pairs(
        recs, SET, carry=recs.columns), SET, keep_scores=False), SET).localCheckpoint()
    for tf in (False, True):
        every = scoring.score_pairs(gammas, PARAMS, SET, tf_adjust=tf).localCheckpoint()
        for threshold in (5.0, 60.0) if tf else (2.0,):
            keys = agreement.agreement_keys(recs, PARAMS, SET, threshold, tf, join_pairs=60.0)
            assert any(sets not in ([()], []) for sets in keys.values()) or threshold == 60
            want = _found(every.where(F.col("match_weight") >= threshold))
            assert _found(linkage.prediction_stage(recs, PARAMS, SET, threshold, tf, join_pairs=60.0)) == want
            assert bool(want) == (threshold < 60)


def test_pairs_that_meet_grow_less_than_the_blocks(spark):
    # one name for all: before, each pair of the name's block met in its join
    recs = _records(spark, 1500, 8, 0.0, names=1)
    keys = agreement.agreement_keys(recs, PARAMS, SET, 5.0, join_pairs=0.0)
    joins = tuple(k for _, k, _ in blocking._joins(SET.blocking_rules, keys))
    finer = blocking.rule_workload(blocking.block_sizes(recs, joins), 2000)
    whole = blocking.rule_workload(blocking.block_sizes(recs, SET.blocking_rules), 2000)
    assert sum(n for n, _ in finer.values()) < sum(n for n, _ in whole.values()) / 3
    # where a further join costs more than it saves, the rules stay whole
    assert agreement.agreement_keys(recs, PARAMS, SET, 5.0, join_pairs=1e9) == {i: [()] for i in range(5)}
    assert agreement.agreement_keys(recs, PARAMS, SET, None) is None
    assert agreement.agreement_keys(recs.limit(0), PARAMS, SET, 5.0) is not None


def test_least_agreements():
    gains = {"a": (3.0, -1.0), "b": (2.0, -1.0), "c": (1.0, 0.0), "r": (4.0, 0.0)}
    # beside the rule: -5 + 4 - 2 = -3; a and b give 4 and 3, c 1
    assert agreement.least_agreements(("r",), gains, -5.0, -3.0) == [frozenset()]
    assert agreement.least_agreements(("r",), gains, -5.0, 1.0) == [frozenset("a")] + [frozenset("bc")]
    assert agreement.least_agreements(("r",), gains, -5.0, 9.0) == []


def test_a_dense_cluster_is_thinned_before_the_rounds(spark):
    n = 300
    ids = spark.range(n).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("x"))
    edges = (ids.toDF("uei_l").crossJoin(ids.toDF("uei_r")).where("uei_l < uei_r").repartition(3)
                .unionByName(spark.createDataFrame([("z1", "z2"), ("z2", None), ("z3", "z3")], "uei_l string, uei_r string")))
    assert edges.count() > 44_000
    assert graph.spanning_edges(edges).count() <= 3 * (n - 1) + 1
    labels = {r.node: r.label for r in graph.component_labels(edges).collect()}
    assert labels == {**{f"{i:04d}": "0000" for i in range(n)}, "z1": "z1", "z2": "z1"}


def test_compared_values_do_not_ride_through_the_similarity(spark):
    recs = _records(spark, 60, 3)
    scored = linkage.prediction_stage(recs, PARAMS, SET, 2.0).select("uei_l", "uei_r", "match_weight")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    passes = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert passes
    after = [line for line in plan.splitlines() if "_scored_name_norm_l" in line and "Project" in line and "CASE" in line]
    assert after
    before_similarity = plan.split("ArrowEvalPython")[0]
    assert not any(f"{c}_l#" in before_similarity for c in ("primary_naics", "entity_structure", "phys_state"))


def test_pairs_of_an_earlier_set_come_once(spark):
    # sets that overlap and share no column with each other, with missing values
    recs = _records(spark, 120, 11, 0.3)
    sets = {0: [("dba_name",), ("phys_city", "primary_naics")], 1: [("phys_city",), ("zip5",)], 2: [()], 3: [], 4: [()]}
    every = blocking.candidate_pairs(recs, SET, carry=recs.columns).collect()
    agree = lambda r, cols: all(r[f"{c}_l"] is not None and r[f"{c}_l"] == r[f"{c}_r"] for c in cols)
    want = sorted((r.uei_l, r.uei_r, r.match_key) for r in every if any(agree(r, s) for s in sets[r.match_key]))
    found = blocking.candidate_pairs(recs, SET, carry=[], agreeing=sets)
    assert sorted((r.uei_l, r.uei_r, r.match_key) for r in found.collect()) == want and want
    assert not [c for c in found.columns if c.startswith("_")]
