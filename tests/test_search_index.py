import os
import random

from linkforge.operators import explore, search_index
from linkforge.plans.workspace import Workspace
from linkforge.session import materialize

SCHEMA = ("cluster_id long, cluster_size long, uei string, legal_name string, name_norm string, "
          "phys_city string, phys_state string, zip5 string")


def _table(spark, names):
    rows = [(i % 7, 3, f"U{i:04d}", name, name.lower().replace(" inc", "") if name else None, "X", "VA", "1") for i, name in enumerate(names)]
    return spark.createDataFrame(rows, SCHEMA)


def _index(table):
    rows = materialize(search_index.numbered_rows(table), "test-rows")
    return rows, materialize(search_index.postings(rows), "test-postings")


def _names(seed, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("abcAB_%\\é") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 3)))
            for _ in range(n)]


def test_index_answers_as_the_scan_does(spark):
    names = _names(1, 300) + [None, "", "ab", "ΑΣΑ ΑΣ", "İstanbul Inc", "common name"] + ["common name"] * 50
    table = _table(spark, names)
    rows, index = _index(table)
    rng = random.Random(2)
    cut = [n[s:s + rng.randint(1, 7)] for n in rng.sample(names[:300], 8) for s in [rng.randrange(len(n))]]
    for query in [*cut, "a%b", "_ab", "ab", "", "%", "common", "MMON NA", "ασ", "ΑΣ", "ΙΣ", "istanbul", "\\", "no such name", "co%on_na"]:
        by_scan = {r.uei for r in table.where(explore.name_match(query)).collect()}
        by_index = {r.uei for r in search_index.candidates(rows, index, query).where(explore.name_match(query)).collect()}
        assert by_index == by_scan, query


def test_index_verifies_few_rows(spark):
    rows, index = _index(_table(spark, ["common name"] * 400 + ["rare thing"] * 3 + ["name common"] * 5))
    assert tuple(search_index.verified_rows(rows, index, "rare").first()) == (3, 3)
    # all trigrams, but not in this order: verified and turned down
    assert search_index.verified_rows(rows, index, "mon name").first().n_matches == 400
    assert search_index.verified_rows(rows, index, "zzz").first().n_verified == 0


def test_long_queries_look_up_their_rarest_grams(spark):
    rows, index = _index(_table(spark, ["alpha beta gamma delta"] * 20 + ["alpha beta gamma delta epsilon"]))
    query = "alpha beta gamma delta eps"
    assert len(search_index.query_grams(query)) > search_index.QUERY_GRAMS
    assert tuple(search_index.verified_rows(rows, index, query).first()) == (1, 1)


def test_blocks_split_common_grams(spark, monkeypatch):
    monkeypatch.setattr(search_index, "BLOCK", 16)
    rows, index = _index(_table(spark, ["same"] * 100))
    assert index.where("gram = 'sam'").count() == 7
    assert search_index.candidates(rows, index, "same").count() == 100
    assert {r.n_rows for r in search_index.gram_counts(index).collect()} == {100}


def test_empty_table(spark):
    rows, index = _index(_table(spark, []))
    assert index.count() == 0 and search_index.candidates(rows, index, "abc").count() == 0


def test_workspace_searches_by_index_while_it_is_up_to_date(spark, tmp_dir):
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    table = _table(spark, ["Acme Ring", "Bring Co", "Other"])

    def store(clusters, latest):
        stored = {"entity_clusters": ws.versions.write(clusters, "entity_clusters"),
                  "registrations_latest": ws.versions.write(latest, "registrations_latest")}
        ws.versions.commit(ws.versions.head(), stored)

    def found(query):
        return [r.uei for r in ws.search(query).collect()]

    alone = _table(spark, ["Acme Ring", "Bring Co", "Other", "Loner"])
    store(table, alone)
    scanned = found("ring"), found("loner"), found("nothing")
    ws.build_search_index()
    assert ws.versions.head()["facts"]["searched"]
    assert (found("ring"), found("loner"), found("nothing")) == scanned == (["U0000", "U0001"], ["U0003"], [])
    # a table changes: its index is out of date and not used
    store(table.where("uei <> 'U0000'"), alone)
    assert found("ring") == ["U0001"]
    ws.build_search_index()
    assert found("ring") == ["U0001"]
