import numpy as np
import pytest
from odd_cases import documents, odd_rows

from linkforge.llm import embedding_dedup, url_filter
from linkforge.llm.token_rollup import TokenRollup
from linkforge.llm.tokenizing import byte_bpe

VECTOR_TYPES = "vec_id bigint, embedding array<double>, label int, links string, file string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], VECTOR_TYPES)


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def planted(spark):
    """Vectors of the table, noisy copies at cosines 0.88 to 1, a large group
    of near copies, exact and scaled copies."""
    base = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()], float)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rng = np.random.default_rng(1)

    def near(v, cosine):
        n = rng.normal(size=len(v))
        n -= n @ v * v
        return cosine * v + np.sqrt(1 - cosine ** 2) * n / np.linalg.norm(n)

    rows = [*base[:400], *(near(v, rng.uniform(.88, 1)) for v in base[:400]), *(near(base[450], .97) for _ in range(150)),
            *[base[460]] * 20, base[460] * 2, base[461] * 3]
    return np.array(rows)


@pytest.mark.parametrize("cell_rows", [2048, 30])
def test_recall_and_exactness(spark, planted, cell_rows):
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors(spark, [(i, v.tolist()) for i, v in enumerate(planted)]),
                                                                cell_rows=cell_rows).collect()}
    units = planted / np.linalg.norm(planted, axis=1, keepdims=True)
    linked = units @ units.T >= 0.9
    np.fill_diagonal(linked, False)
    true = linked.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(planted))])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    close = (units @ units.T >= 0.9) & (units @ units.T < 0.92)
    assert close.sum() > 20
    component = components(range(len(planted)), np.argwhere(linked))
    same = [got[i].component_id == component[i] for i in range(len(planted))]
    assert np.mean(same) > 0.97
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_codes_are_balanced(planted):
    quantiser = embedding_dedup.fit_quantiser(planted[:400])
    bits = np.unpackbits(quantiser.codes(planted[:400] / np.linalg.norm(planted[:400], axis=1, keepdims=True)), axis=1)
    assert bits.shape[1] == 128 and np.abs(bits.mean(axis=0) - 0.5).max() < 0.01


def table_vectors(n):
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["embedding"])["embedding"].to_pylist()[:n]
    return embedding_dedup._units(np.array(rows, float))


def loose_group(centre, n, cosine, seed):
    """Unit vectors round one, pair cosines about ``cosine``."""
    noise = np.random.default_rng(seed).normal(size=(n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * noise / np.linalg.norm(noise, axis=1, keepdims=True)


def band_recall(rows):
    units = embedding_dedup._units(rows)
    codes = embedding_dedup.fit_quantiser(rows).codes(units)
    cosine = units @ units.T
    a, b = np.nonzero(np.triu(cosine >= 0.9, 1))
    bits = embedding_dedup._POP[codes[a] ^ codes[b]]
    hit = embedding_dedup._meeting(bits, 1).any(axis=1)
    bands = [(cosine[a, b] >= lo) & (cosine[a, b] < hi) for lo, hi in ((0.9, 0.92), (0.92, 0.95), (0.95, 2))]
    return [hit[band].mean() for band in bands if band.sum() > 20]


@pytest.mark.parametrize("share", [0.1, 1 / 3, 0.6])
def test_recall_by_cosine_with_a_loose_group(share):
    base = table_vectors(800)
    for seed in range(2):
        recall = band_recall(np.concatenate([base, loose_group(base[seed], int(800 * share / (1 - share)), 0.91, seed)]))
        assert len(recall) >= 2 and min(recall) >= 0.9


@pytest.mark.parametrize("dimensions", [64, 128])
def test_recall_with_a_vector_common_to_all(dimensions):
    base = table_vectors(1500)
    if dimensions > 64:  # directions of little variance, of which some are left out of the codes
        base = np.concatenate([base, 0.005 * np.random.default_rng(1).normal(size=(1500, dimensions - 64))], axis=1)
    recall = band_recall(base + 2 / np.sqrt(dimensions))
    assert recall and min(recall) >= 0.9


def test_links_of_a_loose_group_of_a_third(spark):
    base = table_vectors(400)
    rows = np.concatenate([base, loose_group(base[0], 200, 0.91, 3)])
    cosine = rows @ rows.T
    true = (cosine >= 0.9).sum(axis=1) - 1
    got = embedding_dedup.near_duplicates(vectors(spark, [(i, v.tolist()) for i, v in enumerate(rows)])).collect()
    found = {r.vec_id: r.n_links for r in got}
    assert sum(found.values()) >= 0.95 * true.sum() and all(found[i] <= true[i] for i in found)


def test_unusable_vectors_stand_alone(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0, 3.0]
    rows = [(1, good), (2, good), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]),
            (8, [None, 1.0, 1.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0, 6.0]), (11, [-1.0, 0.5, 0.0]), (None, good), (2, good)]
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in
                 embedding_dedup.near_duplicates(vectors(spark, rows)).collect())
    assert [g for g in got if g[0] in (3, 4, 5, 6, 7, 8, 9, 11)] == [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    assert [g for g in got if g[0] in (1, 2, 10)] == [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False)]
    assert got[0] == (0, 0, None, True)


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).count() == 0
    got = embedding_dedup.near_duplicates(vectors(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


# ---------------------------------------------------------------- rollup ----

CHANGE_TYPES = "op string, doc_id bigint, text string, source string, lang string, change_no bigint, n_docs string"


def changes(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHANGE_TYPES)


def state_totals(state):
    out = {}
    for source, lang, n in state.values():
        docs, tokens = out.get((source, lang), (0, 0))
        out[source, lang] = (docs + 1, tokens + n)
    return out


def live_totals(rollup):
    return {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect() if r.n_docs}


def test_rollup_follows_state_through_batches(spark, tmp_path):
    import random

    rng, count = random.Random(6), lambda t: len(byte_bpe()(t)) if t is not None else 0
    rollup, state = TokenRollup(spark, str(tmp_path / "rollup")), {}
    assert rollup.totals().count() == 0
    for b in range(4):
        rows = []
        for n in range(40):
            i = rng.choice([None, *range(25)])
            op = rng.choice(["insert", "revise", "delete"] if b else ["insert"])
            text = rng.choice([None, "", "some words " * rng.randrange(9)])
            rows.append((op, i, text, rng.choice(["a", "b", None]), rng.choice(["en", None]), n))
        for op, i, text, source, lang, _ in rows:
            if op == "delete":
                state.pop(i, None)
            else:
                state[i] = (source, lang, count(text))
        assert rollup.apply_batch(f"b{b}", changes(spark, rows))
        assert live_totals(rollup) == state_totals(state)
        assert not rollup.apply_batch(f"b{b}", changes(spark, rows))  # delivered again: no change
        assert live_totals(rollup) == state_totals(state)
    sums = rollup.totals().groupBy().sum("n_tokens", "tokens_inserted", "tokens_deleted", "tokens_revised").first()
    assert sums[0] == sums[1] + sums[2] + sums[3]


def test_failed_batch_leaves_no_trace_and_can_be_repeated(spark, tmp_path, monkeypatch):
    rollup = TokenRollup(spark, str(tmp_path / "rollup"))
    rollup.apply_batch("one", changes(spark, [("insert", 1, "a b c", "s", "en", 0)]))
    before = live_totals(rollup)

    def lost(*_):
        raise OSError("executor lost")

    batch = changes(spark, [("revise", 1, "a b c d e f", "s", "en", 0), ("insert", 2, "x", "s", "en", 0)])
    with monkeypatch.context() as m:
        m.setattr(TokenRollup, "_signed", lost)
        with pytest.raises(OSError):
            rollup.apply_batch("two", batch)
    assert live_totals(rollup) == before
    assert rollup.apply_batch("two", batch)
    assert live_totals(rollup) == {("s", "en"): (2, len(byte_bpe()("a b c d e f")) + 1)}


def test_rollup_odd_documents_and_empty_batch(spark, tmp_path, odd_documents, no_documents):
    from pyspark.sql import functions as F

    rollup = TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.apply_batch("empty", no_documents.withColumn("op", F.lit("insert")))
    assert rollup.totals().count() == 0
    named = {}
    for i, t, lang, s in odd_rows():
        if i is not None:
            named[i] = (s, lang, len(byte_bpe()(t)) if t is not None else 0)
    rollup.apply_batch("load", odd_documents.where("doc_id IS NOT NULL").withColumn("op", F.lit("insert")))
    assert live_totals(rollup) == state_totals(named)


def test_rollup_query_against_plain_count(spark):
    from linkforge.llm.queries import op6_token_rollup

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    labels = {}
    for r in spark.read.parquet(f"{d}/labels.parquet").collect():
        toxic, quality = labels.get(r.doc_id, (0, 1))
        labels[r.doc_id] = max(toxic, r.toxic), min(quality, r.quality)
    import re

    state, inserted = {}, 0
    for r in rows:
        toxic, quality = labels.get(r.doc_id, (0, 1))
        inserted += len(byte_bpe()(r.text))
        if not toxic:
            text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text) if quality == 0 else r.text
            state[r.doc_id] = (r.source, r.lang, len(byte_bpe()(text)))
    got = op6_token_rollup(spark, d).collect()
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in got if r.n_docs} == state_totals(state)
    assert sum(r.tokens_inserted for r in got) == inserted


# ------------------------------------------------------------------- urls ----

RULES = url_filter.DEFAULT_RULES


def brute_url(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:next((k for k, c in enumerate(path) if c in "?#"), len(path))]
    fits = []
    for rule, verdict in [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = set(host.replace("-", ".").split("."))
    return host, path, None, "block" if words & set(url_filter.BLOCKED_WORDS) else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://Example.NET/en/x", "https://a.b.example.net/en", "x://notexample.net/en/",
        "http://example.net", "http://net/", "http://foo.net?x=/en/", "http://example.com/de/1#t", "http://my-casino.example.com/",
        "http://casino/", "http://casinos.com/", "http://x.org/fr/?q", "http://ÄXXX.com/", "http://a.xxx", "ftp://u@h:8/p://q/en/",
        "http://h.com/" + "a/" * 5000, "http://example.net/EN/", "http://h.com/xxx/"]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "t", "v") for i, u in enumerate(URLS + URLS[:3])],
                               "page_id bigint, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert len(got) == len(URLS) + 3
    for i, u in enumerate(URLS):
        assert got[i] == brute_url(u), u
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_only_fetched_rules_run(spark):
    rules = [*RULES, url_filter.UrlRule("any", "block", r"^.*\.zip$", (), False), url_filter.site_rule("example.com/dow", "block")]
    df = spark.createDataFrame([(1, "http://a.example.com/download"), (2, "http://b.de/x.zip"), (3, "http://b.de/x")],
                               "page_id bigint, url string")
    got = {r.page_id: r for r in url_filter.filter_urls(df, rules).collect()}
    assert got[1].rule == "example.com/dow" and got[1].verdict == "block"
    assert got[2].pattern == "any" and got[3].verdict == "allow"
    assert got[3].n_candidates == 1 and got[1].n_candidates < len(rules) / 2


def test_index_uses_rarest_token():
    index = url_filter.build_index(RULES, {"example": 900, "net": 500, "en": 5, "com": 800, "de": 10, "org": 3, "fr": 4})
    names = {t: [RULES[i].name for i in rs] for t, rs in index.items()}
    assert names["en"] == ["example.net/en/"] and names["de"] == ["example.com/de/"] and names["org"] == ["org/fr/"]
