import itertools
import random

from pyspark.sql import functions as F

from linkforge.operators import blocking
from linkforge.settings import LinkSettings

SET = LinkSettings()
COLS = ["uei", "name_norm", "name_first4", "zip5", "cage_code", "gov_poc_last", "entity_url"]


def _records(n=120, seed=3, hot_share=0.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        name = rnd.choice(["acme", "acme tools", "bolt", "bolt works", None])
        if rnd.random() < hot_share:
            name = "hot name"
        rows.append((f"{i:06d}", name, name[:4] if name else None, rnd.choice(["10001", "10002", None]),
                     rnd.choice([None, None, "C1", "C2"]), rnd.choice(["P1", "P2", None]),
                     rnd.choice([None, None, None, "u.example"])))
    return rows


def _brute(rows, rules):
    idx = {c: i for i, c in enumerate(COLS)}
    out = {}
    for a, b in itertools.combinations(rows, 2):
        l, r = (a, b) if a[0] < b[0] else (b, a)
        for k, rule in enumerate(rules):
            if all(l[idx[c]] is not None and l[idx[c]] == r[idx[c]] for c in rule):
                out[(l[0], r[0])] = k
                break
    return out


def _pairs(df):
    return {(r.uei_l, r.uei_r): r.match_key for r in df.select("uei_l", "uei_r", "match_key").collect()}


def test_union_of_rules_equals_brute_force(spark):
    rows = _records()
    df = spark.createDataFrame(rows, ",".join(f"{c} string" for c in COLS))
    got = _pairs(blocking.candidate_pairs(df, SET, carry=COLS))
    assert got == _brute(rows, SET.blocking_rules)


def test_salted_hot_blocks_equal_unsalted(spark):
    rows = _records(n=150, hot_share=0.4)
    df = spark.createDataFrame(rows, ",".join(f"{c} string" for c in COLS))
    plain = _pairs(blocking.candidate_pairs(df, SET, carry=COLS, hot_block_rows=10_000))
    salted = _pairs(blocking.candidate_pairs(df, SET, carry=COLS, hot_block_rows=7))
    assert plain == salted == _brute(rows, SET.blocking_rules)
    hot = blocking.hot_blocks(df, SET.blocking_rules, 7).collect()
    assert any(r.block_rows > 7 and r.n_parts >= 2 for r in hot)


def test_hot_block_is_copied_once_per_part(spark):
    n, limit = 300, 30
    df = spark.range(n).selectExpr("lpad(id, 6, '0') AS uei", "'k' AS block_key")
    hot = blocking.hot_blocks(df, (("block_key",),), limit).drop("rule", "block_rows")
    side = blocking._side(df, ["uei", "block_key"], "_l")
    cells = blocking._in_cells(side, "_l", ("block_key",), hot, "uei")
    assert cells.count() == n * (n // limit)   # n^2 / L, not n * (n / L)^2
    largest = cells.groupBy("cell_lo_l", "cell_hi_l").count().agg({"count": "max"}).first()[0]
    assert largest <= 4 * limit


def test_naive_pair_count_is_exact(spark):
    for n in (0, 1, 2, 7, 1000):
        assert blocking.naive_pair_count(spark.range(n)).first()[0] == n * (n - 1) // 2
    # at 3e9 rows the double product was inexact
    row = spark.range(1).selectExpr("3000000001L AS n").selectExpr(
        "CASE WHEN n % 2 = 0 THEN (n div 2) * (n - 1) ELSE n * ((n - 1) div 2) END AS x").first()
    assert row.x == 3000000001 * 3000000000 // 2


def test_plan_has_no_nested_loop_or_cartesian(spark):
    rows = _records(n=30)
    df = spark.createDataFrame(rows, ",".join(f"{c} string" for c in COLS))
    plan = blocking.candidate_pairs(df, SET, carry=COLS)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_rule_counts_fixture(spark):
    import fixture_views as fixtures
    li = fixtures.link_input(spark, "/root/testdata/sf0.001")
    counts = {r.match_key: r.n_pairs for r in blocking.blocking_rule_counts(blocking.candidate_pairs(li)).collect()}
    assert counts == {0: 300, 1: 171, 2: 9, 3: 45, 4: 1}


def test_rule_workload_and_partition_sizing(spark):
    from linkforge.session import MAX_WORK_PARTITIONS, work_partitions
    rows = _records(n=150, hot_share=0.4)
    df = spark.createDataFrame(rows, ",".join(f"{c} string" for c in COLS))
    work = blocking.rule_workload(blocking.block_sizes(df, SET.blocking_rules), 7)
    brute = _brute(rows, SET.blocking_rules)
    # the per-rule estimate bounds the pairs each rule can produce
    for i in range(len(SET.blocking_rules)):
        assert work[i][0] >= sum(1 for k in brute.values() if k == i)
    assert work[1][1] >= 1          # the planted hot name block is found
    floor = spark.sparkContext.defaultParallelism
    assert work_partitions(spark, 10) == floor
    assert work_partitions(spark, 4e9) == 2000
    assert work_partitions(spark, 1e15) == MAX_WORK_PARTITIONS


def test_small_limit_does_not_copy_with_the_block(spark):
    # 3,000 rows at a limit of 3: 1,000 copies of each row before
    df = spark.range(3000).selectExpr("lpad(id, 6, '0') AS uei", "'k' AS block_key")
    hot = blocking.hot_blocks(df, (("block_key",),), 3)
    assert hot.first().n_parts == blocking.SMALL_CELL_PARTS
    cells = blocking._in_cells(blocking._side(df, ["uei", "block_key"], "_l"), "_l", ("block_key",),
                               hot.drop("rule", "block_rows"), "uei")
    assert cells.count() == 3000 * blocking.SMALL_CELL_PARTS
    pairs = blocking.candidate_pairs(df, SET, rules=(("block_key",),), carry=[], hot_block_rows=3)
    assert pairs.count() == pairs.select("uei_l", "uei_r").distinct().count() == 3000 * 2999 // 2
    # cells keep the ordinary size at most
    huge = spark.range(1).selectExpr("0 AS rule", "'k' AS block_key", "1000000L AS block_rows")
    assert blocking.hot_blocks(df, (), 3, huge).first().n_parts == 500


def test_rows_of_a_hot_block_meet_once(spark):
    # cells of parts dealt by hash let both orders of a pair meet, and rows of one part again in every cell
    n, limit = 4000, 200
    df = spark.range(n).selectExpr("lpad(id * id, 9, '0') AS uei", "'k' AS block_key")
    rules = ((0, ("block_key",)),)
    hot = blocking.with_bounds(df, rules, blocking.hot_blocks(df, (("block_key",),), limit), "uei").drop("rule", "block_rows")
    cells = []
    for side, own in (("_l", "cell_lo_l"), ("_r", "cell_hi_r")):
        rows = blocking._in_cells(blocking._side(df, ["uei", "block_key"], side), side, ("block_key",), hot, "uei")
        cells.append({(r[0], r[1]): r[2] for r in rows.where(f"part{side} = {own}").groupBy(
            f"cell_lo{side}", f"cell_hi{side}").count().collect()})
    met = sum(c * cells[1].get(k, 0) for k, c in cells[0].items())
    assert n * (n - 1) // 2 <= met <= 1.4 * n * n / 2
    assert max(cells[0].values()) <= 3 * limit


def test_range_cells_with_repeated_and_missing_ids(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *[f"{k:03d}" for k in range(40)]]), rnd.choice(["a", "b"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "uei string, block_key string")
    got = blocking.candidate_pairs(df, SET, rules=(("block_key",),), carry=[], hot_block_rows=20)
    want = sum(a[1] == b[1] and a[0] is not None and b[0] is not None and a[0] != b[0]
               for a, b in itertools.combinations(rows, 2))
    assert got.count() == want
    assert got.where("uei_l >= uei_r").isEmpty()


def _odd_records(spark, n=300, seed=11):
    """Repeated and missing ids, missing keys."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *[f"{k:03d}" for k in range(n // 2)]]), *r[1:]) for r in _records(n, seed, hot_share=0.1)]
    return spark.createDataFrame(rows, ",".join(f"{c} string" for c in COLS))


def _unlisted(df):
    """Candidate pairs that can't be listed."""
    pairs = blocking.candidate_pairs(df, SET, carry=COLS)
    fail = pairs.select(*[F.raise_error(F.lit("listed")).cast(t).alias(c) for c, t in pairs.dtypes])
    return blocking.with_candidates(fail, blocking.candidates_of(pairs))


def test_rule_counts_without_listing_pairs(spark):
    df = _odd_records(spark)
    pairs = blocking.candidate_pairs(df, SET, carry=COLS)
    want = {r.match_key: r["count"] for r in pairs.groupBy("match_key").count().collect()}
    assert len(want) == 5
    got = blocking.blocking_rule_counts(_unlisted(df))
    assert {r.match_key: r.n_pairs for r in got.collect()} == want
    assert dict(got.dtypes) == {"match_key": "int", "n_pairs": "bigint"}
    # a filter leaves no longer all candidate pairs
    assert {r.match_key: r.n_pairs for r in blocking.blocking_rule_counts(pairs.where("match_key > 2")).collect()} == {
        k: n for k, n in want.items() if k > 2}
    assert blocking.blocking_rule_counts(blocking.candidate_pairs(df.limit(0), SET, carry=COLS)).count() == 0


def test_value_pairs_without_listing_pairs(spark):
    from linkforge.operators import comparisons
    df = _odd_records(spark, n=200, seed=4)
    pairs = blocking.candidate_pairs(df, SET, carry=COLS)
    for column in ("name_norm", "zip5"):
        want = {(r[0], r[1]) for r in pairs.select(f"{column}_l", f"{column}_r").dropna().distinct().collect()}
        got = comparisons.jaro_winkler_pairs(_unlisted(df), column).collect()
        assert {(r[0], r[1]) for r in got} == want and len(got) == len(want)
