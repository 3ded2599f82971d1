import random
import re
from collections import Counter

import duckdb
import pytest
from odd_cases import documents, odd_rows

from linkforge.llm import collocations, oracles, queries

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_count=30, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) >= 2 and a >= min_count:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            found[lang, p] = (a, *min(cuts))
    inside = Counter()
    for (lang, p), (a, *_) in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i:i + k]] = max(inside[lang, p[i:i + k]], a)
    out = []
    for lang in n:
        kept = [(-s, -a, " ".join(p).encode(), a, left, right) for (g, p), (a, s, _, left, right) in found.items()
                if g == lang and 100 * inside[g, p] < 80 * a]
        out += [(lang, i + 1, p.decode(), a, left, right, n[lang], -s) for i, (s, _, p, a, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def phrase_rows(seed=13):
    rng = random.Random(seed)
    vocab = ["New", "York", "new", "york", "city", "of", "the", "Ünïted", "states", "a", "b", "c", "d", "e", "\x00x", "漢字", "é"]
    rows = []
    for i in range(150):
        words = [rng.choice(vocab if rng.random() < 0.8 else ["New York City", "the united states of", "a b a b a b a b", f"rare{i}"]) for _ in range(60)]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ", ", "!", ".\n", "\x0b"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"]), "s"))
    return rows


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(t == "bigint" for c, t in df.dtypes if c not in ("lang", "phrase"))
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dictionary_words, buffer_bytes, per_task", [(1 << 18, 8 << 20, 2_000_000), (8, 700, 100), (0, 90, 100)])
def test_phrases_are_those_of_brute_force(spark, dictionary_words, buffer_bytes, per_task):
    rows = phrase_rows() + odd_rows() * 12
    docs = documents(spark, rows).repartition(4)
    got = collocations.mine_collocations(docs, dictionary_words=dictionary_words, buffer_bytes=buffer_bytes, per_task=per_task)
    assert result(got) == brute(rows)


def test_top_and_ties(spark):
    rows = phrase_rows(3)
    got = collocations.mine_collocations(documents(spark, rows), min_count=12, top=7)
    assert result(got) == brute(rows, 12, 7)


def test_shares_of_a_language_rank_alike(spark):
    rows = [(i, " ".join(f"w{i % 40}x{k} w{i % 40}y{k}." for k in range(20)), "en", "s") for i in range(200)]
    got = collocations.mine_collocations(documents(spark, rows), min_count=5, top=3)
    assert result(got) == brute(rows, 5, 3)


def test_long_text_is_sliced_between_words():
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "c", " ", "  ", "\t", ".", ", ", "\n", "é"]) for _ in range(4000)).encode()
    for limit in (1, 7, 100):
        seen = Counter()
        for data, own in collocations._slices(text, limit):
            words, pieces, first = collocations._tokens(data, own)
            w = words.to_pylist()
            for i in range(first):
                seen[tuple(x for x, p in zip(w[i:i + 4], pieces[i:i + 4]) if p == pieces[i])] += 1
        words, pieces, first = collocations._tokens(text, len(text))
        w = words.to_pylist()
        assert first == len(w)
        assert seen == Counter(tuple(x for x, p in zip(w[i:i + 4], pieces[i:i + 4]) if p == pieces[i]) for i in range(first))


def test_counts_past_64_bits(spark):
    big = 9 * 10**15
    phrases = spark.createDataFrame([(1, 2, 0, 0, 2, big)], "w1 long, w2 long, w3 long, w4 long, size int, f long")
    words = spark.createDataFrame([("en", "x", big, 1), ("en", "y", big + 1, 2)], "lang string, word string, f long, id long")
    row = collocations.scored(phrases, words).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 1) and (row["l"], row["r"]) == (big, big + 1)
    assert collocations.word_hash("en", "x") == words.where("id = 1").select(collocations._word_hash("lang", "word")).first()[0]


def test_empty_table(spark, no_documents):
    assert collocations.mine_collocations(no_documents).count() == 0
    assert collocations.mine_collocations(documents(spark, [(1, None, None, None), (2, " . ", "en", "s")])).count() == 0


def test_sql_gives_the_same(spark, tmp_path):
    rows = phrase_rows(21)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(oracles.OP13)
    names = [c[0] for c in sql.description]
    assert sorted(sql.fetchall()) == sorted(tuple(r) for r in queries.op13_collocations(spark, str(tmp_path)).select(*names).collect())
