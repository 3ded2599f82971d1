import random

from hypothesis import given, settings, strategies as st

from linkforge.operators import graph


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comps = {}
    for n in list(parent):
        comps.setdefault(find(n), []).append(n)
    return {n: min(members) for members in comps.values() for n in members}


def _labels(spark, edges):
    df = spark.createDataFrame(edges, "uei_l string, uei_r string")
    return {r.node: r.label for r in graph.component_labels(df).collect()}


def test_chain_star_and_cycles(spark):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(60)]
    star = [("s0000", f"s{i:04d}") for i in range(1, 40)]
    rev_chain = [(f"r{i + 1:04d}", f"r{i:04d}") for i in range(30)]
    cyc = [("y1", "y2"), ("y2", "y3"), ("y3", "y1"), ("y3", "y3")]
    edges = chain + star + rev_chain + cyc
    assert _labels(spark, edges) == _union_find([(a, b) for a, b in edges if a != b])


@settings(max_examples=6, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_random_graphs_match_union_find(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(2, 80)
    edges = [(f"n{rnd.randrange(n):03d}", f"n{rnd.randrange(n):03d}") for _ in range(rnd.randint(1, 90))]
    edges = [(a, b) for a, b in edges if a != b] or [("n000", "n001")]
    assert _labels(spark, edges) == _union_find(edges)


def test_dense_ids_in_order_of_smallest_member(spark):
    edges = [("b", "c"), ("a", "z"), ("m", "n"), ("d", "b")]
    df = spark.createDataFrame(edges, "uei_l string, uei_r string")
    cc = {r.uei: (r.cluster_id, r.cluster_size) for r in graph.connected_components(df).collect()}
    assert cc["a"] == (0, 2) and cc["z"] == (0, 2)
    assert cc["b"] == (1, 3) and cc["c"] == (1, 3) and cc["d"] == (1, 3)
    assert cc["m"] == (2, 2)


def test_dense_ids_many_partitions(spark):
    keys = spark.range(0, 5000, 1, 7).selectExpr("lpad(cast(id * 7 % 5000 as string), 6, '0') AS k")
    got = sorted((r.k, r.id) for r in graph.dense_ids(keys, "k", "id").collect())
    assert [i for _, i in got] == list(range(5000))


def _stored(spark, labels):
    return spark.createDataFrame(sorted(labels.items()), "node string, label string")


def _frame(spark, edges):
    return spark.createDataFrame(edges, "uei_l string, uei_r string")


def test_edge_changes_equal_a_full_run(spark):
    rng = random.Random(5)
    edges = [tuple(f"n{rng.randrange(60):02d}" for _ in range(2)) for _ in range(40)]
    labels = _union_find([e for e in edges if e[0] != e[1]])
    for _ in range(3):
        after = rng.sample(edges, 30) + [tuple(f"n{rng.randrange(60):02d}" for _ in range(2)) for _ in range(8)]
        changed = graph.change_edges(_stored(spark, labels), _frame(spark, edges), _frame(spark, after))
        labels = {r.node: r.label for r in changed.collect()}
        edges = after
        assert labels == _union_find([e for e in edges if e[0] != e[1]])


def test_edge_changes_at_the_ends(spark):
    chain = [("a", "b"), ("b", "c"), ("d", "e")]
    labels = _stored(spark, _union_find(chain))
    as_dict = lambda df: {r.node: r.label for r in df.collect()}
    none = _frame(spark, [])
    # a self-loop and a reversed repeat change nothing; new nodes may come before all labels
    assert as_dict(graph.add_edges(labels, _frame(spark, [("c", "a"), ("c", "c")]))) == _union_find(chain)
    assert as_dict(graph.add_edges(labels, _frame(spark, [("0", "e"), ("x", "y")]))) == {
        "a": "a", "b": "a", "c": "a", "0": "0", "d": "0", "e": "0", "x": "x", "y": "x"}
    assert as_dict(graph.add_edges(_stored(spark, {"q": "p", "p": "p"}).limit(0), _frame(spark, chain))) == _union_find(chain)
    assert as_dict(graph.change_edges(labels, _frame(spark, chain), none)) == {}
    assert as_dict(graph.change_edges(labels, _frame(spark, chain), _frame(spark, [("a", "b"), ("e", "d")]))) == {
        "a": "a", "b": "a", "d": "d", "e": "d"}
