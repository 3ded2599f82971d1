import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odd_cases import documents, odd_rows
from linkforge.llm import simhash
from linkforge.llm.simhash import BKTree, text_fingerprint


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    """{(id, print)} -> smallest id, over distinct prints."""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    smallest = {}
    for i, v in prints.items():
        smallest[find(v)] = min(i, smallest.get(find(v), i))
    return {i: smallest[find(v)] for i, v in prints.items()}


@given(st.text(alphabet="aAbÄß \t\n\x0b\x1c ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_matches_definition(text):
    assert text_fingerprint(text) == brute_print(text)


def test_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first()
    assert row.h % (1 << 64) == text_fingerprint("One two THREE")


@given(st.sets(st.integers(0, 2 ** 10), min_size=1, max_size=60), st.integers(0, 2 ** 10), st.integers(0, 4))
@settings(max_examples=200, deadline=None)
def test_bk_tree_finds_all_within_radius(values, query, radius):
    tree = BKTree()
    for v in values:
        tree.add(v)
    assert sorted(tree.within(query, radius)) == sorted(v for v in values if (v ^ query).bit_count() <= radius)


@pytest.mark.parametrize("blocks,cell_rows", [(None, 2048), (6, 2048), (None, 8)])
def test_components_of_planted_prints(spark, blocks, cell_rows):
    rng = random.Random(3)
    values = [0, 7, (1 << 64) - 1]
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):  # chains drift away bit by bit
            values.append(v)
            for _ in range(rng.randrange(1, 5)):
                v ^= 1 << rng.randrange(64)
    signed = [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]
    classes = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp bigint, doc_id bigint")
    edges = simhash.link_forest(classes, 3, blocks, cell_rows).collect()
    prints = {i: v % (1 << 64) for i, v in enumerate(signed)}
    expected = brute_components(prints)
    at = {v: i for i, v in enumerate(signed)}
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        a, b = find(at[e.a]), find(at[e.b])
        parent[max(a, b)] = min(a, b)
    assert {i: find(i) for i in prints} == expected


def test_near_duplicates_odd_rows(spark, odd_documents):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    got = simhash.near_duplicates(odd_documents).collect()
    assert len(got) == len(rows)
    named = {i: brute_print(t) for i, t in rows if i is not None}
    # texts of null ids take part in linking; here each has a twin or stands alone
    component = brute_components(named)
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == format(named[r.doc_id], "016x") and r.component_id == component[r.doc_id]


def test_near_duplicates_whole_query(spark, sf_documents):
    from linkforge.llm.queries import op5_simhash

    texts = {r.doc_id: r.text for r in sf_documents.collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    component = brute_components(prints)
    got = op5_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (format(v, "016x"), component[i]) for i, v in prints.items()}


def test_near_duplicates_empty(no_documents):
    assert simhash.near_duplicates(no_documents).count() == 0


def test_repeated_rows_share_a_component(spark):
    df = documents(spark, [(5, "same words here now", "en", "a")] * 3 + [(9, "SAME words here now", "en", "a")])
    assert {(r.component_id, r.kept) for r in simhash.near_duplicates(df).collect() if r.doc_id == 5} == {(5, True)}
