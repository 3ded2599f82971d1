import hashlib
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from odd_cases import documents, odd_rows
from linkforge.llm import exact_dedup, line_dedup
from linkforge.llm.exact_dedup import PatriciaTrie


@given(st.lists(st.binary(max_size=12), max_size=40))
@settings(max_examples=200, deadline=None)
def test_trie_holds_exactly_the_inserted_strings(keys):
    trie = PatriciaTrie()
    for i, k in enumerate(keys):
        node = trie.insert(k)
        node.owners = min(i, node.owners) if node.owners is not None else i
    found = {k: n.owners for n, k in PatriciaTrie.terminals(trie.root)}
    assert found == {k: keys.index(k) for k in keys}


def test_trie_spills_its_heaviest_subtree():
    trie = PatriciaTrie()
    for k in (b"aaaa", b"aabb", b"b"):
        trie.insert(k).owners = [1]
    edge, subtree = trie.spill()
    assert edge == ord("a") and sorted(k for _, k in PatriciaTrie.terminals(subtree)) == [b"aaaa", b"aabb"]
    assert trie.bytes == 1


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for i, t, *_ in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[key], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_odd_rows(spark, odd_documents):
    assert Counter(map(tuple, exact_dedup.exact_duplicates(odd_documents).collect())) == brute_exact(odd_rows())


def test_exact_dedup_spilling_tries_give_the_same(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randrange(30))) for _ in range(60)]
    rows = [(i, rng.choice(texts), "en", "s") for i in range(600)]
    df = documents(spark, rows).repartition(6)
    got = exact_dedup.exact_duplicates(df, trie_bytes=64, partition_bytes=1 << 20)
    assert Counter(map(tuple, got.collect())) == brute_exact(rows)


def test_texts_longer_than_a_trie_holds_are_compared_by_their_bytes(spark):
    rows = [(1, "ab" * 500, "en", "s"), (2, "ab " * 500, "en", "s"), (3, "ba" * 500, "en", "s"), (4, "ab" * 500, "en", "s"), (5, "short", "en", "s")]
    got = exact_dedup.exact_duplicates(documents(spark, rows).repartition(3), trie_bytes=100)
    assert Counter(map(tuple, got.collect())) == brute_exact(rows)


def test_exact_dedup_empty(no_documents):
    assert exact_dedup.exact_duplicates(no_documents).count() == 0


def brute_lines(rows, ratio, min_pages, distinct=False):
    bare = lambda s: s.strip(" \t\n\x0b\x0c\r")
    pages, held, seen = Counter(), Counter(), set()
    for _, t, _, s in rows:
        body = (s, tuple(bare(x) for x in (t or "").split("\n") if bare(x)))
        if distinct and body in seen:
            continue
        seen.add(body)
        pages[s] += 1
        for x in {bare(x) for x in (t or "").split("\n")} - {""}:
            held[s, x] += 1
    gone = {k for k, n in held.items() if n >= min_pages and n > pages[k[0]] * ratio}
    out = []
    for i, t, _, s in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if (s, bare(x)) not in gone]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    lines = ["menu", " menu\t", "imprint", "", "  ", "unique"] + [f"line {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(lines[:6] if rng.random() < .3 else lines) for _ in range(rng.randrange(8))), "en",
             rng.choice(["a", "a", "b", None])) for i in range(200)] + odd_rows()
    got = line_dedup.drop_boilerplate(documents(spark, rows), ratio=0.2, min_pages=3)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == brute_lines(rows, 0.2, 3)
    assert got.columns.count("n_lines") == 1 and "taken" in got.columns


def test_line_dedup_of_small_hosts_and_empty_tables(spark, no_documents):
    rows = [(i, "same line", "en", "copies") for i in range(5)] + [(10 + i, f"menu\npage {i}", "en", "small") for i in range(4)]
    rows += [(20, "menu\nthe only page", "en", "one")]
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(documents(spark, rows), distinct_pages=True).collect()}
    assert got == {**{i: "same line" for i in range(5)}, **{10 + i: f"page {i}" for i in range(4)}, 20: "menu\nthe only page"}
    counted = line_dedup.drop_boilerplate(documents(spark, rows[:5]))
    assert {r.text for r in counted.collect()} == {""}
    assert line_dedup.drop_boilerplate(no_documents).count() == 0


def test_line_dedup_main_path_is_native(spark, odd_documents):
    plan = line_dedup.drop_boilerplate(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
