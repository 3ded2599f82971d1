import math

from pyspark.sql import functions as F

from linkforge.operators import comparisons, scoring
import fixture_views as fixtures
from fixture_views import fixture_stages
from linkforge.settings import LinkSettings

SET = LinkSettings()


def test_fixture_weight_and_cluster_figures(spark):
    st = fixture_stages(spark, "/root/testdata/sf0.001")
    s = st.scored()
    assert s.count() == 526
    assert s.where("match_weight >= 2").count() == 271
    assert s.where("match_weight >= 5").count() == 258
    c = st.clusters().agg(F.count_distinct("cluster_id"), F.count(F.lit(1)), F.max("cluster_size")).first()
    assert tuple(c) == (50, 194, 4)


def test_weight_is_sum_of_log_bayes_factors(spark):
    p = fixtures.fixed_parameters()
    row = {c.gamma: -1 for c in SET.comparisons}
    row.update({"gamma_name_norm": 4, "gamma_zip5": 1, "gamma_phys_state": 0})
    df = spark.createDataFrame([row])
    got = scoring.score_pairs(df, p, SET).first()
    expected = math.log2(1e-4 / (1 - 1e-4)) + math.log2(.75 / .02) + math.log2(.7 / .02) + math.log2(.2 / .9)
    assert abs(got.match_weight - expected) < 1e-12
    assert abs(got.match_probability - 2 ** expected / (1 + 2 ** expected)) < 1e-15


def test_gamma_levels_jaro(spark):
    df = spark.createDataFrame([
        ("martha", "marhta", None, None), ("abc", "abc", "x", None), ("abcdefgh", "abzzzzzz", "dwayne", "duane"),
        ("a", "abcdefghijklmnopqrstuvwxyz", "dixon", "dicksonx")],
        "name_norm_l string, name_norm_r string, dba_name_l string, dba_name_r string")
    for c in SET.comparisons[2:]:
        df = df.withColumn(f"{c.column}_l", F.lit(None).cast("string")).withColumn(f"{c.column}_r", F.lit(None).cast("string"))
    got = [(r.gamma_name_norm, r.gamma_dba_name) for r in comparisons.gamma_vectors(df, SET).orderBy("name_norm_l").collect()]
    # a/abc..z: bound below 0.7 -> 0 without a call; abc==abc -> exact;
    # abcdefgh/abzzzzzz 0.5 -> 0; martha/marhta 0.961 -> 3; dwayne/duane .84 -> 0; dixon .81 -> 0
    assert got == [(0, 0), (4, -1), (0, 0), (3, -1)]


def test_raising_threshold_only_refines_clusters(spark):
    st = fixture_stages(spark, "/root/testdata/sf0.001")
    from linkforge.plans.linkage import cluster_stage
    lo, _ = cluster_stage(st.scored(), st.latest(), 2.0)
    hi, _ = cluster_stage(st.scored(), st.latest(), 12.0)
    lo_map = {r.uei: r.cluster_id for r in lo.collect()}
    groups = {}
    for r in hi.collect():
        groups.setdefault(r.cluster_id, set()).add(lo_map[r.uei])
    assert all(len(v) == 1 for v in groups.values())


def test_bound_leaves_out_no_pair_that_reaches_the_threshold(spark):
    from linkforge.plans.linkage import prediction_stage
    st = fixture_stages(spark, "/root/testdata/sf0.001")
    params = fixtures.fixed_parameters()
    n_pairs = st.pairs().count()
    for tf in (False, True):
        every = {(r.uei_l, r.uei_r): r.match_weight for r in st.scored(tf).collect()}
        for threshold in (2.0, 5.0, 12.0, -60.0):
            got = {(r.uei_l, r.uei_r): r.match_weight
                   for r in prediction_stage(st.records(True), params, SET, threshold, tf).collect()}
            assert got == {k: w for k, w in every.items() if w >= threshold}
            kept = scoring.may_reach(st.pairs(), params, SET, threshold, tf).count()
            assert len(got) <= kept and (kept < n_pairs or threshold < 0)


def test_bound_holds_for_missing_values_and_frequencies(spark):
    params = fixtures.fixed_parameters()
    row = {c.column: "x" for c in SET.comparisons} | {f"log2_tf_{c.column}": -3.0 for c in SET.comparisons if c.tf_adjust}
    rows = [row | {"uei": "a"}, row | {"uei": "b", "dba_name": None}, row | {"uei": "c", "log2_tf_zip5": None},
            row | {"uei": "d", "cage_code": "y"}]
    types = ", ".join(f"{c} {'double' if c.startswith('log2') else 'string'}" for c in rows[0])
    recs = spark.createDataFrame([tuple(r[c] for c in rows[0]) for r in rows], types)
    recs = recs.select("*", *scoring.bound_columns(SET))
    left, right = (recs.select([F.col(c).alias(c + s) for c in recs.columns]) for s in ("_l", "_r"))
    pairs = left.crossJoin(right).where("uei_l < uei_r")
    for tf in (False, True):
        scored = scoring.score_pairs(comparisons.gamma_vectors(pairs, SET), params, SET, tf_adjust=tf).collect()
        assert len(scored) == 6
        for r in scored:
            kept = scoring.may_reach(pairs, params, SET, r.match_weight, tf).where(
                f"uei_l = '{r.uei_l}' AND uei_r = '{r.uei_r}'")
            assert kept.count() == 1


def test_predictions_write_neither_pairs_nor_vectors(spark, monkeypatch):
    written = []
    for module in (fixtures, fixtures.blocking):
        monkeypatch.setattr(module, "materialize", lambda df, label, keep=module.materialize: (written.append(label), keep(df, label))[1])
    st = fixtures.FixtureStages(spark, "/root/testdata/sf0.001")
    assert st.predictions(2.0).count() == 271 and st.edges().count() == 258
    assert not {"pairs", "gammas"} & set(written) and "scored" in written
