"""Jaro-Winkler similarity: the only scalar the linkage needs that Spark
lacks. It runs inside an Arrow UDF; the callers reduce the work first (equal
strings and pairs whose length bound is below every threshold never reach
it), repeated pairs come from a per-worker memo, and the rest of each Arrow
batch is scored in one vectorised numpy pass (``jaro_winkler_batch``, equal
to the per-pair form bit for bit, about 3x faster on business names).

Semantics: computed on UTF-8 bytes; match window max(len)//2 - 1; greedy
left-to-right matching, each byte of the right string used once; the
Winkler boost (common prefix up to 4, scale 0.1) applies only when the
Jaro value exceeds 0.7.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values --------------------------------------------------------
PREFIX_SCALE = 0.1
MAX_PREFIX = 4
BOOST_THRESHOLD = 0.7
# -------------------------------------------------------------------------


def jaro_winkler(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    s1 = a.encode("utf-8")
    s2 = b.encode("utf-8")
    l1, l2 = len(s1), len(s2)
    if l1 == 0 or l2 == 0:
        return 0.0
    window = max(max(l1, l2) // 2 - 1, 0)
    used = bytearray(l2)
    left_matches = []
    for i in range(l1):
        c = s1[i]
        for j in range(max(0, i - window), min(l2, i + window + 1)):
            if not used[j] and s2[j] == c:
                used[j] = 1
                left_matches.append(c)
                break
    m = len(left_matches)
    if m == 0:
        return 0.0
    right_matches = [s2[j] for j in range(l2) if used[j]]
    half_transpositions = sum(1 for x, y in zip(left_matches, right_matches) if x != y)
    t = half_transpositions // 2
    jaro = (m / l1 + m / l2 + (m - t) / m) / 3
    if jaro > BOOST_THRESHOLD:
        p = 0
        for k in range(min(MAX_PREFIX, l1, l2)):
            if s1[k] != s2[k]:
                break
            p += 1
        jaro = math.fma(p * PREFIX_SCALE, 1 - jaro, jaro)
    return jaro


def _padded(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(N x Lmax uint8 matrix, lengths) from byte strings, built without a
    per-row Python copy."""
    lengths = np.fromiter((len(e) for e in encoded), dtype=np.int64, count=len(encoded))
    width = int(lengths.max()) if len(lengths) else 0
    mat = np.zeros((len(encoded), max(width, 1)), dtype=np.uint8)
    if width:
        flat = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        rows = np.repeat(np.arange(len(encoded)), lengths)
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        mat[rows, np.arange(flat.size) - starts] = flat
    return mat, lengths


def _jaro_winkler_block(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Vectorised form of ``jaro_winkler`` for pairs with non-empty strings:
    the same greedy left-to-right matching, one position of the left string
    at a time for all pairs together, and the same floating-point steps."""
    n, wa = a.shape
    wb = b.shape[1]
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    cols = np.arange(wb)[None, :]
    used = np.zeros((n, wb), dtype=bool)
    a_hit = np.zeros((n, wa), dtype=bool)
    in_b = cols < lb[:, None]
    rows = np.arange(n)
    for i in range(wa):
        cand = ((b == a[:, i:i + 1]) & ~used & in_b
                & (cols >= (i - window)[:, None]) & (cols <= (i + window)[:, None]))
        cand &= (i < la)[:, None]
        j = cand.argmax(axis=1)
        found = cand[rows, j]
        used[rows[found], j[found]] = True
        a_hit[found, i] = True
    m = a_hit.sum(axis=1)
    # Matched bytes in order on each side; transpositions = mismatches // 2.
    seq_a = np.zeros((n, wa), dtype=np.int16) - 1
    seq_b = np.zeros((n, wa), dtype=np.int16) - 2
    ra, ca = np.nonzero(a_hit)
    seq_a[ra, (np.cumsum(a_hit, axis=1) - 1)[ra, ca]] = a[ra, ca]
    rb, cb = np.nonzero(used)
    seq_b[rb, (np.cumsum(used, axis=1) - 1)[rb, cb]] = b[rb, cb]
    within = np.arange(wa)[None, :] < m[:, None]
    t = ((seq_a != seq_b) & within).sum(axis=1) // 2
    mf = m.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (mf / la + mf / lb + (mf - t) / mf) / 3
    jaro = np.where(m == 0, 0.0, jaro)
    k = min(MAX_PREFIX, wa, wb)
    same = (a[:, :k] == b[:, :k]) & (np.arange(k)[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    boost = np.flatnonzero(jaro > BOOST_THRESHOLD)
    if len(boost):
        jaro[boost] = [math.fma(p * PREFIX_SCALE, 1 - j, j)
                       for p, j in zip(prefix[boost].tolist(), jaro[boost].tolist())]
    return jaro


BATCH_BUCKET = 4096


def jaro_winkler_batch(left: list[str], right: list[str]) -> np.ndarray:
    """``jaro_winkler`` over many pairs (no NULLs), equal to the scalar form
    bit for bit. Pairs are bucketed by length so padding stays small."""
    ea = [x.encode("utf-8") for x in left]
    eb = [x.encode("utf-8") for x in right]
    out = np.zeros(len(ea), dtype=np.float64)
    la_all = np.fromiter((len(x) for x in ea), dtype=np.int64, count=len(ea))
    lb_all = np.fromiter((len(x) for x in eb), dtype=np.int64, count=len(eb))
    ok = np.flatnonzero((la_all > 0) & (lb_all > 0))
    order = ok[np.argsort(np.maximum(la_all[ok], lb_all[ok]), kind="stable")]
    for start in range(0, len(order), BATCH_BUCKET):
        idx = order[start:start + BATCH_BUCKET]
        a, la = _padded([ea[i] for i in idx])
        b, lb = _padded([eb[i] for i in idx])
        out[idx] = _jaro_winkler_block(a, la, b, lb)
    return out


# Scores of earlier batches of the worker, emptied when full.
MEMO_PAIRS = 200_000
MEMO_BYTES = 256
_MEMO: dict[tuple[str, str], float] = {}


def _distinct_scores(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Scores of unlike pairs, those of earlier batches from the memo."""
    out = np.array([_MEMO.get(p, np.nan) for p in pairs], dtype=np.float64)
    new = np.flatnonzero(np.isnan(out))
    if len(new):
        fresh = [pairs[i] for i in new]
        out[new] = jaro_winkler_batch([p[0] for p in fresh], [p[1] for p in fresh])
        if len(_MEMO) + len(fresh) > MEMO_PAIRS:
            _MEMO.clear()
        _MEMO.update((p, s) for p, s in zip(fresh, out[new].tolist()) if len(p[0]) + len(p[1]) <= MEMO_BYTES)
    return out


def score_arrays(left: pa.Array, right: pa.Array) -> pa.Array:
    """NULL in -> NULL out. The batch's strings are dictionary-encoded, its
    distinct pairs of codes scored in one vectorised call, if an earlier batch
    had not; only distinct strings become Python objects."""
    valid = pc.and_(pc.is_valid(left), pc.is_valid(right)).to_numpy(zero_copy_only=False)
    out = np.zeros(len(left), dtype=np.float64)
    idx = np.flatnonzero(valid)
    if len(idx):
        take = pa.array(idx)
        ls, rs = pc.take(left, take).dictionary_encode(), pc.take(right, take).dictionary_encode()
        width = len(rs.dictionary)
        codes = ls.indices.to_numpy().astype(np.int64) * width + rs.indices.to_numpy()
        distinct, where = np.unique(codes, return_inverse=True)
        lefts, rights = ls.dictionary.to_pylist(), rs.dictionary.to_pylist()
        scores = _distinct_scores([(lefts[a], rights[b]) for a, b in
                                   zip((distinct // width).tolist(), (distinct % width).tolist())])
        out[idx] = scores[where]
    return pa.array(out, type=pa.float64(), mask=~valid)


@F.arrow_udf(T.DoubleType())
def jaro_winkler_udf(left: pa.Array, right: pa.Array) -> pa.Array:
    return score_arrays(left, right)


def upper_bound(left: Column, right: Column) -> Column:
    """An upper bound of the Jaro-Winkler value from byte lengths only:
    Jaro <= (min/max + 2) / 3; the boost adds at most 0.4 * (1 - Jaro)."""
    la = F.octet_length(left).cast("double")
    lb = F.octet_length(right).cast("double")
    j = (F.least(la, lb) / F.greatest(la, lb) + F.lit(2.0)) / F.lit(3.0)
    return F.when(j > BOOST_THRESHOLD, j + PREFIX_SCALE * MAX_PREFIX * (1 - j)).otherwise(j)
