import duckdb
import pandas as pd
from hypothesis import given, settings, strategies as st

from linkforge.functions.jaro import jaro_winkler, jaro_winkler_udf

KNOWN = [("martha", "marhta", 0.9611111111111111), ("dwayne", "duane", 0.84),
         ("dixon", "dicksonx", 0.8133333333333332), ("abcdefgh", "abzzzzzz", 0.5)]


def test_known_values():
    for a, b, v in KNOWN:
        assert abs(jaro_winkler(a, b) - v) < 1e-12


def test_nulls_and_empty():
    assert jaro_winkler(None, "a") is None
    assert jaro_winkler("", "a") == 0.0
    assert jaro_winkler("abc", "abc") == 1.0


_TEXT = st.text(alphabet="abcdeé ñxyz", min_size=1, max_size=25)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_TEXT, _TEXT), min_size=1, max_size=30))
def test_equals_duckdb(pairs):
    df = pd.DataFrame(pairs, columns=["a", "b"])
    ref = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM df").fetchnumpy()["s"]
    for (a, b), r in zip(pairs, ref):
        got = jaro_winkler(a, b)
        assert got == r, (a, b, got, r)
        assert 0.0 <= got <= 1.0


def test_udf_in_spark(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in KNOWN] + [(None, "x")], "a string, b string")
    got = [r[0] for r in df.select(jaro_winkler_udf("a", "b")).collect()]
    assert [round(x, 12) for x in got[:-1]] == [round(v, 12) for _, _, v in KNOWN]
    assert got[-1] is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcé xyz-", min_size=0, max_size=45),
                          st.text(alphabet="abcé xyz-", min_size=0, max_size=45)), min_size=1, max_size=60))
def test_batch_equals_scalar(pairs):
    import numpy as np

    from linkforge.functions.jaro import jaro_winkler_batch
    got = jaro_winkler_batch([a for a, _ in pairs], [b for _, b in pairs])
    assert np.array_equal(got, np.array([jaro_winkler(a, b) for a, b in pairs]))


def test_pairs_of_earlier_batches_are_not_scored_again(monkeypatch):
    import pyarrow as pa

    from linkforge.functions import jaro

    calls = []
    real = jaro.jaro_winkler_batch
    monkeypatch.setattr(jaro, "_MEMO", {})
    monkeypatch.setattr(jaro, "MEMO_PAIRS", 3)
    monkeypatch.setattr(jaro, "jaro_winkler_batch", lambda a, b: calls.append(len(a)) or real(a, b))
    left, right = pa.array(["martha", "dixon", None, "martha"]), pa.array(["marhta", "dicksonx", "x", "marhta"])
    first = jaro.score_arrays(left, right).to_pylist()
    assert jaro.score_arrays(left, right).to_pylist() == first and calls == [2]
    assert first[0] == jaro.jaro_winkler("martha", "marhta") and first[2] is None
    jaro.score_arrays(pa.array(["a" * 300, "b", "c"]), pa.array(["a", "bc", "cd"]))
    assert len(jaro._MEMO) <= 3 and ("a" * 300, "a") not in jaro._MEMO
