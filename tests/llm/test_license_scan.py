import random
import re

import duckdb
import pytest
from odd_cases import documents, odd_rows
from pyspark.sql import functions as F

from linkforge.llm import license_scan, oracles, queries
from linkforge.llm.license_templates import BASE, TEMPLATES, Template

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
MIT = next(t for t in TEMPLATES if t.label == "mit" and t.kind == "body")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_spans(text, templates=TEMPLATES):
    """All spans by comparing each place with each template."""
    w, found = words(text), set()
    for t in templates:
        tw = words(t.text)
        if t.kind != "body":
            found |= {(i, i + len(tw) - 1, t.label, t.kind, 1.0) for i in range(len(w)) if w[i:i + len(tw)] == tw}
            continue
        votes = {}
        for i in range(len(w) - 3):
            for at in range(len(tw) - 3):
                if w[i:i + 4] == tw[at:at + 4]:
                    votes.setdefault(i - at, set()).add(at)
        cells = {}
        for d in votes:
            near = [(e, at) for e in votes if d <= e <= d + 3 for at in votes[e]]
            cells[d] = (len({at + k for _, at in near for k in range(4)}), min(e + at for e, at in near), max(e + at + 3 for e, at in near))
        for d, (covered, s, e) in cells.items():
            if all((covered, -d) >= (cells[o][0], -o) for o in cells if abs(o - d) <= 3):
                score = covered / max(len(tw), e - s + 1)
                if score >= 0.8:
                    found.add((s, e, t.label, t.kind, score))
    return sorted(found)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + rng.choice([0, 1])] = rng.choice([[], ["other"], ["the"]])
    return " ".join(w)


def planted_rows():
    rng = random.Random(11)
    fill = lambda n: " ".join(rng.choice(["the", "of", "software", "license", "version", "mit", "gnu", "cc", "by", "2", "x"]) for _ in range(n))
    rows = []
    for i in range(60):
        parts = [fill(rng.randrange(12))]
        for _ in range(rng.randrange(4)):
            parts += [edited(rng, rng.choice(TEMPLATES).text, rng.choice([0, 0, 0, 1, 3, 9])), fill(rng.randrange(9))]
        rows.append((i, " -- ".join(parts), "en", "s"))
    rows += [(100, MIT.text * 3, "en", "s"), (101, "MIT License " * 300, "en", "s"), (102, "mit License K LİCENSE Mit\x00license", "en", "s"),
             (103, "é MIT, LICENSE! GNU\nGENERAL public-license cc_by CC/BY CCé BY", "en", "s"), (104, "mit", "en", "s")]
    return rows


def spans_by_row(df):
    return sorted(((r["doc_id"], r["n_words"], [(s["first"], s["last"], s["label"], s["kind"], s["score"]) for s in r["spans"]])
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows", [planted_rows(), odd_rows()])
def test_spans_are_those_of_brute_force(spark, rows):
    got = spans_by_row(license_scan.scan_licenses(documents(spark, rows)))
    assert got == sorted(((i, len(words(t)), brute_spans(t)) for i, t, *_ in rows), key=repr)


def test_edited_bodies_are_found(spark):
    rng = random.Random(3)
    bodies = [t for t in TEMPLATES if t.kind == "body"]
    rows = [(i, "some words before " + edited(rng, t.text, 2) + " and after", "en", "s") for i, t in enumerate(bodies * 5)]
    found = {r["doc_id"]: {s["label"] for s in r["spans"]} for r in license_scan.scan_licenses(documents(spark, rows)).collect()}
    hit = [t.label in found[i] for i, t in enumerate(bodies * 5)]
    assert sum(hit) >= 0.9 * len(hit)


def test_a_body_with_many_words_changed_is_no_span(spark):
    half = " ".join(w if i % 3 else "changed" for i, w in enumerate(MIT.text.split()))
    assert [r["spans"] for r in license_scan.scan_licenses(documents(spark, [(1, half, "en", "s")])).collect()] == [[]]


def test_periodic_text_has_every_place_and_no_long_span(spark):
    row = license_scan.digest(license_scan.scan_licenses(documents(spark, [(1, "mit license " * 500, "en", "s")]))).first()
    assert (row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (500, 0, 998, "mit")


def test_copies_and_clashing_columns(spark):
    rows = [(i, "Released under the MIT License.", "en", "s") for i in range(40)]
    docs = documents(spark, rows).withColumn("n_words", F.col("n_chars"))
    out = license_scan.scan_licenses(docs)
    assert out.count() == 40 and set(docs.columns) | {"spans"} == set(out.columns)
    assert {len(r["spans"]) for r in out.collect()} == {1}


def test_empty_table_and_own_templates(spark, no_documents):
    assert license_scan.scan_licenses(no_documents).count() == 0
    own = [Template("house", "notice", "for internal use only")]
    got = license_scan.digest(license_scan.scan_licenses(documents(spark, [(1, "For internal use only!", "en", "s")]), own)).first()
    assert (got["n_base"], got["labels"], got["base_labels"], got["first_word"]) == (0, "house", "", None)


def test_sql_gives_the_same(spark, tmp_path):
    rows = planted_rows() + odd_rows()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(oracles.OP11)
    names = [c[0] for c in sql.description]
    want = sorted(map(repr, sql.fetchall()))
    got = queries.op11_license_scan(spark, str(tmp_path)).select(*names)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_main_path_holds_no_python(spark, sf_documents):
    plan = license_scan.diagonal_votes(sf_documents, TEMPLATES, "text")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
    assert [t.label for t in BASE] == ["gpl", "apache", "cc-by", "mit"]
