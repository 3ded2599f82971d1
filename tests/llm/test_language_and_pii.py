import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odd_cases import documents, odd_rows
from linkforge.llm import language_id, pii
from linkforge.llm.bilstm_crf import BiLstmCrf


def test_held_out_accuracy(spark, sf_documents):
    from linkforge.llm.queries import op3_language_id

    lang = {r.doc_id: r.lang for r in sf_documents.collect()}
    got = op3_language_id(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    judged = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in judged]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(odd_documents, no_documents):
    got = language_id.identify(odd_documents).collect()
    assert len(got) == len(odd_rows())
    for r, (i, t, *_) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                             sorted(odd_rows(), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None))):
        if i is not None:
            assert (r.lang_pred == "und") == (t is None or not any(c.isalpha() for c in t)), t
    assert language_id.identify(no_documents).count() == 0


def test_language_without_labels_is_unknown(spark):
    df = documents(spark, [(i, "some words", None, "s") for i in range(8)])
    assert {(r.lang_pred, r.score) for r in language_id.identify(df).collect()} == {("und", 0.0)}


def test_prediction_ignores_label_source_and_id(spark):
    train = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 12)]
    model = language_id.learn_prototypes(documents(spark, train))
    rows = documents(spark, [(1, "the tree", "de", "x"), (99, "the tree", None, None), (7, "der baum", "en", "s")])
    got = {(r.doc_id): (r.lang_pred, r.score) for r in language_id.predict(rows, model, ["doc_id"]).collect()}
    assert got[1] == got[99] and got[1][0] == "en" and got[7][0] == "de"


def test_gram_codes_bind_by_place():
    grams = language_id.GramVectors(256, 1)
    a, b = (language_id.gram_codes(np.array([32, ord(x), ord(y), 32], np.int32)) for x, y in ("ab", "ba"))
    rows = [grams.of(np.unique(c)) for c in (a, b)]
    va, vb = (grams.vectors[r].astype(int) for r in rows)
    assert abs((va.sum(axis=0) @ vb.sum(axis=0)) / 256) < 1


# --------------------------------------------------------------------- pii ----


def brute_spans(t):
    digits = lambda x: re.sub("[^0-9]", "", x)

    def luhn(s):
        r = [int(c) for c in s][::-1]
        return sum(r[0::2] + [sum(divmod(2 * x, 10)) for x in r[1::2]]) % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
               if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
                 if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m.group())) <= 15],
    }


@given(st.lists(st.sampled_from(["a", "Z", ".", "-", "@", "1", "255", "999", "+", " ", "(", "x.de", "4111111111111111", "ü", "%"]),
                max_size=40))
@settings(max_examples=500, deadline=None)
def test_base_spans_match_definition(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute_spans(text)


def test_base_spans_are_linear_in_long_texts():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "+" + "1(" * 100_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    model = BiLstmCrf(7, np.ones((3, 3), bool), np.ones(3, bool), 4, 5, 1)
    chars, tags = rng.integers(0, 7, (4, 9)), rng.integers(0, 3, (4, 9))
    _, grads = model.loss_and_grads(chars, tags)
    for name, values in model.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in values.shape)
            old = values[at]
            values[at] = old + 1e-5
            up = model.loss_and_grads(chars, tags)[0]
            values[at] = old - 1e-5
            down = model.loss_and_grads(chars, tags)[0]
            values[at] = old
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], abs=1e-6)


def test_windows_cover_every_place():
    for size in (0, 1, pii.READ, pii.READ + 1, pii.READ + pii.STRIDE, 5000):
        starts = list(pii.window_starts(size))
        assert {p for s in starts for p in range(s, s + pii.READ)} >= set(range(size))
        assert all(s < size for s in starts)
        # a span of up to READ - STRIDE characters lies whole in one window
        assert all(y - x <= pii.STRIDE for x, y in zip(starts, starts[1:]))


@given(st.integers(0, 10_000), st.booleans())
@settings(max_examples=40, deadline=None)
def test_decoding_finds_the_best_path(seed, quiet):
    rng = np.random.default_rng(seed)
    model = pii.new_tagger(seed)
    for name in model.p:
        model.p[name] = model.p[name] + rng.normal(0, 0.7, model.p[name].shape)
    model.p["out_b"][0] += 4.0 * quiet
    chars = rng.integers(0, pii.OTHER + 1, (6, 30))

    def states(way):
        p, n = model.p, model.hidden
        out, h, c = np.zeros((*chars.shape, n)), np.zeros((len(chars), n)), np.zeros((len(chars), n))
        for t in range(chars.shape[1])[::1 if way == "f" else -1]:
            z = p["chars"][chars[:, t]] @ p[f"x_{way}"] + h @ p[f"h_{way}"] + p[f"c_{way}"]
            i, f, o = (1 / (1 + np.exp(-z[:, k * n:(k + 1) * n])) for k in range(3))
            c = f * c + i * np.tanh(z[:, 3 * n:])
            out[:, t] = h = o * np.tanh(c)
        return out

    emit = np.concatenate([states("f"), states("b")], axis=2) @ model.p["out"] + model.p["out_b"]
    trans, start = model.p["trans"] + model.barred, model.p["start"] + model.no_start
    rows = np.arange(len(chars))

    def score(tags):
        total = start[tags[:, 0]] + emit[rows, 0, tags[:, 0]]
        for t in range(1, chars.shape[1]):
            total = total + trans[tags[:, t - 1], tags[:, t]] + emit[rows, t, tags[:, t]]
        return total

    best = start + emit[:, 0]
    for t in range(1, chars.shape[1]):
        best = (best[:, :, None] + trans).max(axis=1) + emit[:, t]
    assert score(model.decode(chars)) == pytest.approx(best.max(axis=1), abs=1e-3)


def test_national_phone_moves_labels():
    window, labels = pii.national_phone("call +1 (826) 555-4081 or a@b.de", [("phone", 5, 22), ("email", 26, 32)])
    assert window == "call (826) 555-4081 or a@b.de"
    assert [window[a:b] for _, a, b in labels] == ["(826) 555-4081", "a@b.de"]


@pytest.fixture(scope="module")
def pii_documents(spark):
    import random

    rng = random.Random(5)

    def phone():
        return f"+{rng.randrange(1, 99)} ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"

    def filler():
        return " ".join(rng.choice(["some", "words", "of", "text", "version 2.0", "in 1999"]) for _ in range(rng.randrange(3, 30)))

    kinds = [phone, lambda: f"user{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
             lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), lambda: "4111 1111 1111 1111"]
    rows = [(i, f"{filler()} {rng.choice(kinds)()} {filler()}", "en", "s") for i in range(400)]
    return documents(spark, rows + odd_rows()), dict((i, t) for i, t, *_ in rows)


def test_pii_base_columns_and_added_spans(pii_documents):
    df, texts = pii_documents
    got = pii.find_pii(df).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id in texts and r.doc_id >= len(odd_rows()):
            spans = brute_spans(texts[r.doc_id])
            base = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in spans[k]]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in pii.KINDS]
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert set(base) <= set(r.spans.split(",")) or not base


def test_tagger_adds_what_patterns_miss(pii_documents):
    tagger = pii.train(pii.training_windows(pii_documents[0]))
    text = "please call (826) 555-4081 some day"
    (base, added), = pii.find_in_texts([text], tagger)
    assert not any(base.values()) and [text[a:b] for a, b in added["phone"]] == ["(826) 555-4081"]
    (_, none), = pii.find_in_texts(["plain words of text, version 2.0 in 1999"], tagger)
    assert not any(none.values())


def test_tagger_finds_planted_spans_without_base_matches(pii_documents):
    """Recall of spans that no base pattern matches, in words not trained on."""
    tagger = pii.train(pii.training_windows(pii_documents[0]))
    rng = np.random.default_rng(11)
    cases, clean = [], []
    for _ in range(300):
        words = ["".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 10))) for _ in range(rng.integers(20, 200))]
        clean.append(" ".join(words))
        kind = pii.KINDS[rng.integers(len(pii.KINDS))]
        spelt, at = pii.respelt(kind, pii.planted(kind, rng), rng), rng.integers(1, len(words))
        before = " ".join(words[:at]) + " "
        cases.append((before + spelt + " " + " ".join(words[at:]), kind, len(before), len(before) + len(spelt)))
    hits, tried = 0, 0
    for (text, kind, a, b), (base, added) in zip(cases, pii.find_in_texts([c[0] for c in cases], tagger)):
        if not any(base.values()):
            tried += 1
            hits += (a, b) in added[kind]
    assert tried > 250 and hits >= 0.85 * tried
    assert sum(any(added.values()) for _, added in pii.find_in_texts(clean, tagger)) <= 3


def test_values_decide_however_spelt():
    good = [("email", "ann [at] mail [dot] example [dot] org"), ("email", "ann at mail dot org"), ("email", "a.b @ c . de"),
            ("ip", "10 . 0 . 0 . 7"), ("ip", "10[.]0[.]0[.]255"), ("card", "4111/1111/1111/1111"), ("phone", "0049 30/123 456")]
    bad = [("email", "look at example.org"), ("email", "ann at home"), ("ip", "10 . 0 . 0 . 256"), ("ip", "1 . 2 . 3"),
           ("card", "4111/1111/1111/1112"), ("phone", "12 34"), ("phone", "12 a 3456 789"), ("phone", ""), ("card", "")]
    assert all(pii._well_formed(*x) for x in good) and not any(pii._well_formed(*x) for x in bad)


def test_spans_cut_by_both_windows_are_joined():
    text = "x" * 10 + "4111/1111/1111/1111" + "y" * 10
    got = pii.reconcile(text, Counter(), {("card", 10, 22), ("card", 15, 29)}, {k: [] for k in pii.KINDS})
    assert got["card"] == [(10, 29)]


def test_pii_without_spans_or_rows(spark, no_documents):
    got = pii.find_pii(documents(spark, [(1, None, "en", "s"), (2, "text 12", "en", "s")])).collect()
    assert {(r.n_email + r.n_ip + r.n_card + r.n_phone, r.spans) for r in got} == {(0, "")}
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_pii(no_documents).count() == 0
