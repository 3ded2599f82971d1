"""Very long texts, extreme numbers and added tokens."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
from odd_cases import documents
from tokenizers import Tokenizer

from linkforge.llm import embedding_dedup, language_id, pii, simhash
from linkforge.llm.tokenizing import byte_bpe


def test_parts_of_many_zeros_are_no_error():
    assert pii.base_spans("0" * 5000 + "1.2.3.4")["ip"] == [(0, 5007)]
    assert pii.base_spans("0" * 5000 + "256.2.3.4")["ip"] == []
    assert pii.base_spans("0.00.000.0000")["ip"] == [(0, 13)]


def test_added_tokens_are_those_of_the_tokenizer_file():
    known, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_bpe()
    for text in ("x<|endoftext|>y", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n", "<|endoftext", "a<|endoftext|>" + " " * 50):
        assert encode(text).tolist() == known.encode(text, add_special_tokens=False).ids


def test_vectors_of_any_length_and_size_link(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(10)]
    rows += [(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.0]), (102, [1.0, 2.0, 3.1]), (103, [-1.0, 2.0, 0.0])]
    rows += [(200, [1e200, 2e200, -1e200, 5e199]), (201, [1e-200, 2e-200, -1e-200, 5e-201]), (202, [1.0, 2.0, -1.0, 0.5]),
             (203, [5e-324, 1e-323, -5e-324, 0.0]), (300, None), (301, [0.0] * 4), (302, [float("inf")] * 4), (303, [])]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    v = {i: np.array(x) / np.abs(x).max() for i, x in rows if i < 300}
    for i in v:
        linked = [j for j in v if j != i and len(v[i]) == len(v[j]) and v[i] @ v[j] / np.linalg.norm(v[i]) / np.linalg.norm(v[j]) >= 0.9]
        assert got[i]["n_links"] == len(linked), i
    assert got[101]["component_id"] == 100 and got[202]["component_id"] <= 200
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (300, 301, 302, 303))


def test_text_of_many_different_letters_is_bundled_in_bounded_memory():
    rng = random.Random(1)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(30_000))
    letters, grams = language_id.LetterTable(), language_id.GramVectors(256, 42)
    tracemalloc.start()
    (vector, n), = language_id._text_vectors([text], letters, grams)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 30_000 and peak < 60 << 20
    points = [ord(c) for c in " " + text + " "]
    plain = np.zeros(256, np.int64)
    for a, b, c in zip(points, points[1:], points[2:]):
        plain += np.roll(grams.letter(a), 2).astype(int) * np.roll(grams.letter(b), 1) * grams.letter(c)
    assert np.abs(vector - plain).max() < 1


def test_fingerprint_of_a_long_text_takes_little_memory():
    text = " ".join(f"w{i % 5000}" for i in range(300_000))
    tracemalloc.start()
    simhash.text_fingerprint(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 * 300_000


def brute_language(rows, dimensions=512, seed=42):
    """Bundles and cosines straight from the definition."""
    vectors = language_id.GramVectors(dimensions, seed)

    def bundle(text):
        spelt = "".join(c.lower() if len(c.lower()) == 1 else c for c in (text or ""))
        points = [ord(c) for c in " ".join(["", *"".join(c if c.isalpha() else " " for c in spelt).split(" "), ""])]
        points = [p for i, p in enumerate(points) if p != 32 or i == 0 or points[i - 1] != 32]
        total = np.zeros(dimensions)
        for a, b, c in zip(points, points[1:], points[2:]):
            total += np.roll(vectors.letter(a), 2).astype(int) * np.roll(vectors.letter(b), 1) * vectors.letter(c)
        return total if any(p != 32 for p in points) else None

    sums = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and (v := bundle(text)) is not None and not _held_out(i):
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    langs = sorted(sums)
    model = np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs])
    model -= model.mean(axis=0)
    model /= np.linalg.norm(model, axis=1, keepdims=True)
    out = {}
    for i, text, _ in rows:
        v = bundle(text)
        cosines = model @ v / np.linalg.norm(v) if v is not None else None
        out[i] = ("und", 0.0) if v is None else (langs[int(cosines.argmax())], float(np.clip(cosines.max(), 0, 1)))
    return out


def _held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language_is_that_of_plain_bundles_and_cosines(spark):
    rng = random.Random(3)
    words = {"en": "the house and this tree with that thing", "de": "das haus und dieser baum mit jenem ding", "fr": "la maison et cet arbre avec cette chose"}
    rows = [(i, " ".join(rng.choice(words[x].split()) for _ in range(rng.randrange(1, 30))) + rng.choice(["", "!", " 12", "É"]), x)
            for i, x in enumerate(rng.choice(list(words)) for _ in range(80))]
    rows += [(200, None, "en"), (201, " 12 .", "de"), (202, "the", None), (203, "ÀÉ", None)]
    got = language_id.identify(documents(spark, [(i, t, x, "s") for i, t, x in rows]), dimensions=512)
    want = brute_language(rows)
    for r in got.collect():
        assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 2e-4 and r["held_out"] == _held_out(r["doc_id"])
