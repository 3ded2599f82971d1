import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from linkforge.operators import blocking, comparisons, model
import fixture_views as fixtures
from linkforge.settings import LinkSettings

SET = LinkSettings()


def test_random_pairs_all_pairs_when_under_cap(spark):
    df = spark.range(40).selectExpr("lpad(cast(id as string), 4, '0') AS uei")
    got = [tuple(r) for r in model.random_pairs(df, 10_000).select("uei_l", "uei_r").collect()]
    ids = sorted(r.uei for r in df.collect())
    assert len(got) == len(set(got))
    assert set(got) == set(itertools.combinations(ids, 2))


def test_random_pairs_capped_sample(spark):
    df = spark.range(2000).selectExpr("lpad(cast(id as string), 5, '0') AS uei")
    pairs = model.random_pairs(df, 20_000)
    rows = [tuple(r) for r in pairs.select("uei_l", "uei_r").collect()]
    assert len(rows) == len(set(rows))
    assert all(a < b for a, b in rows)
    assert 14_000 < len(rows) < 26_000


def test_random_pair_plan_bounds():
    assert model.random_pair_plan(10, 5_000_000) == (10, 10, 10)
    slots, claims, counting = model.random_pair_plan(875_000, 5_000_000)
    assert slots == 875_000 and claims == 12 and counting <= slots


def _loglik(params, g, n, active, prior):
    lm = model._log_prob_table(params, SET, "m", active, g) + math.log(prior)
    lu = model._log_prob_table(params, SET, "u", active, g) + math.log(1 - prior)
    return float((n * np.logaddexp(lm, lu)).sum())


def test_em_likelihood_never_falls(spark):
    st_records = fixtures.link_input(spark, "/root/testdata/sf0.001").select(*SET.record_columns())
    start = model.parameters_from_u(model.u_estimates(st_records, SET), SET)
    patterns = model.training_patterns(st_records, ("name_norm",), SET)
    g, n = model.collect_patterns(patterns, SET)
    active = [j for j, c in enumerate(SET.comparisons) if c.column != "name_norm"]
    prior = model._pass_prior(start, SET, ["name_norm"])
    params = start
    prev = _loglik(params, g, n, active, prior)
    for _ in range(10):
        params, prior, _ = model.em_step(params, SET, g, n, active, prior)
        cur = _loglik(params, g, n, active, prior)
        assert cur >= prev - 1e-6 * abs(prev)
        prev = cur


def test_em_one_step_frame_matches_driver_step(spark):
    st_records = fixtures.link_input(spark, "/root/testdata/sf0.001").select(*SET.record_columns())
    p = fixtures.fixed_parameters()
    from linkforge.operators import blocking
    pairs = blocking.candidate_pairs(st_records, SET)
    patterns = comparisons.gamma_patterns(comparisons.gamma_vectors(pairs, SET), SET)
    frame = {(r.comparison, r.gamma): r.m_probability for r in model.em_one_step_frame(patterns, p, SET).collect()}
    g, n = model.collect_patterns(patterns, SET)
    new, _, _ = model.em_step(p, SET, g, n, list(range(len(SET.comparisons))), p.prior)
    for (c, k), v in frame.items():
        assert abs(new.levels[(c, k)]["m"] - v) < 1e-4 or v < 1e-5


def test_training_separates_matches(spark):
    recs = fixtures.link_input(spark, "/root/testdata/sf0.001").select(*SET.record_columns())
    params = model.train(recs, SET)
    for c in SET.comparisons:
        assert params.log2_bf(c.column, c.exact_level) > 0, c.column
    assert all(0 < v["u"] <= 1 and 0 < v["m"] <= 1 for v in params.levels.values())


def test_term_frequencies_sum_to_one(spark):
    recs = fixtures.link_input(spark, "/root/testdata/sf0.001")
    tf = model.term_frequencies(recs, "phys_city")
    assert abs(tf.agg(F.sum("tf")).first()[0] - 1.0) < 1e-12


def test_random_pair_plan_expects_max_pairs_at_every_size():
    from linkforge.operators.model import random_pair_plan

    for n in (1_000, 3_163, 20_000, 1_000_000, 7_000_000, 10_000_001, 10 ** 9):
        for most in (1_000, 5_000_000):
            slots, claims, counting = random_pair_plan(n, most)
            expected = (n - 1) * claims * counting / (2 * n) if claims < n else n * (n - 1) / 2
            assert abs(expected / min(most, n * (n - 1) / 2) - 1) < 0.1, (n, most)
            assert claims == 1 or counting <= slots
    assert random_pair_plan(10 ** 9, 5_000_000)[1:] == (1, 10_000_000)   # only sampled slots are shuffled


def test_random_pairs_meet_their_number(spark):
    from linkforge.operators.model import random_pairs

    df = spark.range(2_000).selectExpr("lpad(id, 6, '0') AS uei")
    got = random_pairs(df, 1_000)
    assert abs(got.count() - 1_000) < 200
    assert got.distinct().count() == got.count()
    assert random_pairs(df.limit(40), 10 ** 6).count() == 40 * 39 // 2


def test_null_terms_keep_their_rows_and_do_not_share_a_key(spark):
    from linkforge.operators import model
    from linkforge.settings import Comparison, LinkSettings

    settings = LinkSettings(comparisons=(Comparison("city", tf_adjust=True),))
    df = spark.createDataFrame([(str(i), None if i % 3 else "x" if i % 2 else "y") for i in range(30)], "uei string, city string")
    rows = model.with_term_frequencies(df, settings).collect()
    assert len(rows) == 30 and all((r.tf_city is None) == (r.city is None) for r in rows)
    assert {r.city: r.tf_city for r in rows if r.city} == {"x": 0.5, "y": 0.5}


def test_weighted_patterns_equal_listed_pairs(spark):
    import random

    rng = random.Random(3)
    value = lambda *of: rng.choice(of)
    rows = [tuple([f"U{i:03d}"] + [value("acme widgets", "acme widget", "zeta labs", None) if c == "name_norm" else
                                   value("DENVER", "RESTON") if c == "phys_city" else value("22201", "80202", None) if c == "zip5"
                                   else value("x", "y", None) for c in SET.compared_columns]) for i in range(150)]
    rows += [("H%03d" % i, *rows[0][1:]) for i in range(60)]  # one profile holds a third of the rows
    cols = list(dict.fromkeys([*SET.compared_columns, "zip5", "phys_city"]))
    recs = spark.createDataFrame([r + ("22201",) * (len(cols) - len(SET.compared_columns)) for r in rows],
                                 ", ".join(f"{c} string" for c in [SET.unique_id, *cols]))
    for block in SET.training_blocks:
        pairs = blocking.candidate_pairs(recs, SET, rules=(tuple(block),), carry=cols)
        listed = comparisons.gamma_patterns(comparisons.gamma_vectors(pairs, SET, keep_scores=False), SET)
        got = model.training_patterns(recs, block, SET)
        names = sorted(listed.columns)
        assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, listed.select(names).collect()))
    assert model.training_patterns(recs.limit(0), SET.training_blocks[0], SET).count() == 0


def test_listed_patterns_equal_those_of_stored_vectors(spark):
    from fixture_views import fixture_stages
    st = fixture_stages(spark, "/root/testdata/sf0.001")
    cols = [c.gamma for c in SET.comparisons] + ["n_pairs"]
    want = model.block_patterns(st.records(), ("name_norm",), SET, st.gammas())
    got = model.block_patterns(st.records(), ("name_norm",), SET, listed=True)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    # a repeated key gives no pair with itself, as among candidates
    twice = st.records().unionByName(st.records())
    pairs = fixture_stages(spark, "/root/testdata/sf0.001").pairs().where("name_norm_l = name_norm_r").count()
    assert model.block_patterns(twice, ("name_norm",), SET, listed=True).agg({"n_pairs": "sum"}).first()[0] == 4 * pairs
