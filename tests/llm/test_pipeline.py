"""Pipeline stages against plain Python, and odd inputs through all stages."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from odd_cases import documents, odd_rows
from test_exact_and_line import brute_lines
from test_mixing_and_packing import WORD
from test_simhash import brute_components, brute_print

from linkforge.llm import language_id, line_dedup, mixing

D = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def stages(spark, stored):
    """Input and output rows of each stage, on the small documents."""
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, D))
        out[name] = (docs, result)
        docs = result
    return out

def test_stage_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and all(stages[n][1].columns == stages[n][0].columns for n in names[:-1])

def test_language_stage_keeps_documents_with_letters(stages):
    before, after = stages["language_id"]
    kept = {r.doc_id for r in after.collect()}
    assert all(r.doc_id in kept for r in before.collect() if len(re.findall(r"[^\W\d_]", r.text or "")) > 20)

def test_line_stage(stages):
    before, after = stages["line_dedup"]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in before.collect()]
    brute = brute_lines(rows, line_dedup.RATIO, line_dedup.MIN_PAGES, distinct=True)
    expected = Counter({k[:2]: n for k, n in brute.items() if k[3] == 0 or WORD.search(k[1])})
    assert Counter((r.doc_id, r.text) for r in after.collect()) == expected
    assert all(r.n_chars == len(r.text) for r in after.collect())

def test_simhash_stage_keeps_one_of_each_group(stages):
    before, after = stages["simhash_near_dedup"]
    rows = before.collect()
    component = brute_components({r.doc_id: brute_print(r.text) for r in rows})
    keep = set(component.values())
    assert Counter(after.collect()) == Counter(r for r in rows if r.doc_id in keep)

def test_mix_stage_follows_targets(stages):
    before, after = stages["mixing"]
    size, taken = Counter(), Counter()
    for r in before.collect():
        size[r.source] += len(WORD.findall(r.text))
    for r in after.collect():
        taken[r.source] += len(WORD.findall(r.text))
    sources = sorted(size)
    targets = mixing.capped_targets([size[s] for s in sources], [(5, 2, 1)[i % 3] for i in range(len(sources))])
    assert all(abs(taken[s] - t) <= 6 * mixing.BLOCK_WORDS for s, t in zip(sources, targets))

def test_pack_stage(stages):
    before, after = stages["packing"]
    texts = defaultdict(list)
    for r in before.collect():
        texts[r.doc_id].append(r.text)

    got = after.collect()
    assert {r.doc_id for r in got} == set(texts)
    from linkforge.llm.tokenizing import byte_bpe

    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.length
    assert tokens == Counter({i: sum(len(byte_bpe()(t)) + 1 for t in ts) for i, ts in texts.items()})

def test_query_runs_all_stages(spark, stages):
    from linkforge.llm.queries import QUERIES

    got = QUERIES["pipeline"](spark, D)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in got.collect()) == Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in stages["packing"][1].collect())

@pytest.mark.parametrize("stage", range(5))
def test_each_stage_takes_odd_rows_and_empty_tables(spark, stored, odd_documents, no_documents, stage):
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, stored(odd_documents), D)
    assert out.count() > 0
    if stage < 4:
        assert out.columns == odd_documents.columns
    assert run(spark, stored(no_documents), D).count() == 0

def test_simhash_stage_keeps_one_of_repeated_rows(spark, stored):
    df = stored(documents(spark, [(1, "same text again here", "en", "s")] * 4 + [(None, "other text that is alone", "en", "s")] * 2))
    out = corpus_pipeline.simhash_stage(spark, df, D).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1]

def test_language_stage_rejects_only_texts_without_language(spark, stored):
    rows = odd_rows() + [(100 + i, "the house and the tree are here", "en", "s") for i in range(20)]
    kept = Counter(r.doc_id for r in corpus_pipeline.language_stage(spark, stored(documents(spark, rows)), D).collect())
    assert all(100 + i in kept for i in range(20)) and 0 not in kept and 1 not in kept and 12 not in kept
    assert language_id.UNKNOWN == "und"

def test_a_copy_group_of_a_third_of_a_source_reaches_the_corpus(spark, stored):
    copy = "first line of the copied text\nsecond line of the copied text"
    rows = [(i, copy + ("" if i % 2 else " \n"), "en", "s") for i in range(50)]
    rows += [(50 + i, f"menu of the site\npage {i} has text of its own", "en", "s") for i in range(100)]
    out = corpus_pipeline.line_stage(spark, stored(documents(spark, rows)), D)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts) == 150 and all(texts[i] == rows[i][1] for i in range(50))
    assert all(texts[50 + i] == f"page {i} has text of its own" for i in range(100))
    kept = Counter(r.text.strip() for r in corpus_pipeline.simhash_stage(spark, stored(out), D).collect())
    assert kept[copy] == 1

def test_language_stage_rejects_junk_and_unlearned_languages(spark, stored):
    import random

    rng = random.Random(4)
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source")
    learned = [tuple(r) for r in docs.collect()]
    letters, base64 = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHabcdefghijklmnopqrstuvwxyz0123456789+/"
    junk = ["".join(rng.choice(a) for _ in range(n)) for a in (letters, letters + "    ", base64) for n in (100, 400, 5000)]
    foreign = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * n for n in (1, 20)]
    foreign += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι"]
    short = [" ".join(t.split()[:4]) for _, t, lang, _ in learned if lang == "en" and len(t.split()) > 50][:40]
    rows = learned + [(10_000 + i, t, None, "s") for i, t in enumerate(junk + foreign)]
    rows += [(20_000 + i, t, None, "s") for i, t in enumerate(short)]
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, stored(documents(spark, rows)), D).collect()}
    assert not any(10_000 <= i < 20_000 for i in kept)
    assert sum(i >= 20_000 for i in kept) >= 39 and len(short) == 40
    assert {i for i, t, *_ in learned if re.search(r"[^\W\d_]", t)} <= kept
