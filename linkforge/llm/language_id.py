"""Language ID (operator 3): hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code point). A
3-gram's vector binds its letters' vectors, each rotated by its place, with an
elementwise product; a text's vector bundles (adds) those of its 3-grams, and a
language's prototype those of its labelled texts, each text scaled to length
one. The mean of the prototypes, which they have in common, is taken from
prototypes before comparing. A text gets the language of the prototype with
the highest cosine; the cosine, cut to 0..1, is its score.

The highest of the cosines with centred prototypes is never below 0, so the
score can't tell that a text is of no learned language. Its fit can: the share
of a language's 3-gram frequencies that the text's have, by their projection on
the mean frequencies of the language's texts; about 1 for a text of the language
whatever its length, 0 for a text that shares no 3-gram with it. ``known`` asks
for ``FIT`` of the best language, and for less the fewer 3-grams the text has.

Text is lower-cased; runs of characters that aren't letters count as one
space, and a space stands before and after the whole.

Learning: one pass bundles 3-gram counts per language inside the tasks and
sends one vector per task and language; they are added up by (language,
dimension), a map-side combined sum. Two times languages x dimensions numbers reach the
driver and go out with the prediction's tasks: their size depends on the
number of labels only. Prediction is a scan without a shuffle.

Edge cases: null text or text without a letter gives ``und`` and score 0; so
does every text when nothing could be learned. Equal cosines: the smaller
language. Very long texts are counted in full. Repeated rows give repeated
results. Language, source and id take no part in a prediction; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 42
HELD_OUT = 2
FOLDS = 4
UNKNOWN = "und"
FIT = 0.3
FIT_GRAMS = 20  # with so many 3-grams, half of FIT is asked for

_SPACE = 32
_BITS = 21  # a code point
_BLOCK_CHARS = 1 << 20
_MOST_GRAMS = 16_384  # vectors a worker keeps
_SLICE = 2048  # 3-grams bundled at a time
_TEXT_ROWS = 256  # rows of a batch whose texts are Python strings at a time


def fold(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


class LetterTable:
    """Code point -> lower-case letter or space."""

    def __init__(self):
        self.table = np.full(0x110000, -1, np.int32)

    def map(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        if (out < 0).any():
            for p in np.unique(points[out < 0]).tolist():
                low = chr(p).lower()
                self.table[p] = (ord(low) if len(low) == 1 else p) if chr(p).isalpha() else _SPACE
            out = self.table[points]
        return out


class GramVectors:
    """3-gram code -> vector, made when first asked for and kept by row."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.codes = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)
        self.vectors = np.empty((_MOST_GRAMS, dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            rng = np.random.default_rng([self.seed, point])
            self.letters[point] = (rng.integers(0, 2, self.dimensions, np.int8) * 2 - 1).astype(np.int8)
        return self.letters[point]

    def gram(self, code: int) -> np.ndarray:
        mask = (1 << _BITS) - 1
        a, b, c = code >> 2 * _BITS, code >> _BITS & mask, code & mask
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` for at most ``_SLICE`` sorted unique codes. Where
        the table would overflow it is begun anew."""
        at, known = self._find(codes)
        if not known.all():
            if len(self.codes) + int((~known).sum()) > _MOST_GRAMS:
                self.codes, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
                at, known = self._find(codes)
            new, used = codes[~known], len(self.codes)
            for i, c in enumerate(new.tolist()):
                self.vectors[used + i] = self.gram(c)
            codes_all = np.concatenate([self.codes, new])
            rows_all = np.concatenate([self.rows, used + np.arange(len(new))])
            order = np.argsort(codes_all, kind="stable")
            self.codes, self.rows = codes_all[order], rows_all[order]
            at = np.searchsorted(self.codes, codes)
        return self.rows[at]

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        return at, known

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weighted sum of the codes' vectors, some at a time."""
        total = np.zeros(self.dimensions, np.float32)
        for s in range(0, len(codes), _SLICE):
            rows = self.of(codes[s:s + _SLICE])
            total += counts[s:s + _SLICE].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return total


def gram_codes(points: np.ndarray) -> np.ndarray:
    """Codes of the 3-grams of letters and single spaces."""
    points = points[(points != _SPACE) | np.r_[True, points[:-1] != _SPACE]]
    p = points.astype(np.int64)
    return p[:-2] << 2 * _BITS | p[1:-1] << _BITS | p[2:]


def count_blocks(texts: list[str | None], letters: LetterTable) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, last text + 1, codes, bounds, counts): unique 3-grams of
    each text of a block; those of text k stand at bounds[k]:bounds[k + 1]."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (size == 0 or size + len(texts[upto] or "") <= _BLOCK_CHARS):
            size += len(texts[upto] or "") + 1
            upto += 1
        codes, counts, bounds = [], [], [0]
        for text in texts[at:upto]:
            raw = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
            mapped = letters.map(raw) if len(raw) else np.zeros(0, np.int32)
            if (mapped == _SPACE).all():
                bounds.append(bounds[-1])
                continue
            found = np.sort(gram_codes(np.r_[_SPACE, mapped, _SPACE]))
            starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
            codes.append(found[starts])
            counts.append(np.diff(np.r_[starts, len(found)]))
            bounds.append(bounds[-1] + len(starts))
        none = np.zeros(0, np.int64)
        yield at, upto, np.concatenate([none, *codes]), np.array(bounds), np.concatenate([none, *counts])
        at = upto


def _text_vectors(texts: list[str | None], letters: LetterTable, grams: GramVectors) -> Iterator[tuple[np.ndarray, float] | None]:
    """Bundled vector of each text and its number of 3-grams, None without a letter."""
    for first, upto, codes, bounds, counts in count_blocks(texts, letters):
        for k in range(upto - first):
            a, b = bounds[k], bounds[k + 1]
            yield (grams.bundle(codes[a:b], counts[a:b]), float(counts[a:b].sum())) if b > a else None


def _some_texts(column: pa.Array) -> Iterator[list[str | None]]:
    for at in range(0, len(column), _TEXT_ROWS):
        yield column.slice(at, _TEXT_ROWS).to_pylist()


def _learn_task(batches: Iterator[pa.RecordBatch], dimensions: int, seed: int) -> Iterator[pa.RecordBatch]:
    letters, grams, sums = LetterTable(), GramVectors(dimensions, seed), {}
    for batch in batches:
        bundles = (b for texts in _some_texts(batch.column(1)) for b in _text_vectors(texts, letters, grams))
        for lang, bundled in zip(batch.column(0).to_pylist(), bundles):
            if bundled is not None:
                vector, n = bundled[0].astype(np.float64), bundled[1]
                shares = vector / n
                sums[lang] = sums.get(lang, 0.0) + np.concatenate(
                    [vector / max(1e-9, float(np.linalg.norm(vector))), shares, [1.0, float(shares @ shares)]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
        names=["lang", "bundle"])


def learn_prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS,
                     seed: int = SEED) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Learned languages in order, their centred prototypes of length one, and
    their fit profiles: a text's mean 3-gram vector times a profile is its fit.
    Profiles are NaN where two texts or more don't tell a language's level."""
    bundles = (labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
                       .mapInArrow(partial(_learn_task, dimensions=dimensions, seed=seed), "lang string, bundle array<double>"))
    rows = (bundles.select("lang", F.posexplode("bundle").alias("dim", "value"))
                   .groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect())
    langs = sorted({r["lang"] for r in rows})
    place = {lang: i for i, lang in enumerate(langs)}
    sums = np.zeros((len(langs), 2 * dimensions + 2))
    for r in rows:
        sums[place[r["lang"]], r["dim"]] = round(r["value"], 6)  # sums come in any order
    prototypes, shares, n, squares = sums[:, :dimensions], sums[:, dimensions:-2], sums[:, -2], sums[:, -1]
    # between different texts only: a text's product with itself is no level of the language
    level = ((shares ** 2).sum(axis=1) - squares) / np.maximum(1, n * (n - 1))
    profiles = shares / np.where(level > 1e-6, level * np.maximum(1, n), np.nan)[:, None]
    prototypes /= np.maximum(1e-9, np.linalg.norm(prototypes, axis=1, keepdims=True))
    if len(langs) > 1:
        prototypes -= prototypes.mean(axis=0)
        prototypes /= np.maximum(1e-9, np.linalg.norm(prototypes, axis=1, keepdims=True))
    return langs, prototypes, profiles


def _is_known(vector: np.ndarray, n: float, best: int, profiles: np.ndarray) -> bool:
    """Whether the text fits a learned language; so does one whose best
    language has no level to judge by."""
    fits = (vector @ profiles.T) / n
    return bool(np.isnan(fits[best]) or np.nanmax(fits) >= FIT * n / (n + FIT_GRAMS))


def _predict_task(batches: Iterator[pa.RecordBatch], langs: list[str], prototypes: np.ndarray, profiles: np.ndarray,
                  seed: int, text_at: str, judge: bool) -> Iterator[pa.RecordBatch]:
    letters, grams = LetterTable(), GramVectors(prototypes.shape[1] if langs else 1, seed)
    target = prototypes.T.astype(np.float32)
    for batch in batches:
        preds, scores, known = [], [], []
        column, _, field = text_at.partition(".")
        spelt = batch.column(column).field(field) if field else batch.column(column)
        for bundled in (b for texts in _some_texts(spelt) for b in _text_vectors(texts, letters, grams)):
            if bundled is None or not langs:
                preds.append(UNKNOWN)
                scores.append(0.0)
                known.append(False)
                continue
            vector, n = bundled
            cosines = np.round((vector @ target).astype(np.float64) / max(1e-9, float(np.linalg.norm(vector))), 5)
            best = int(np.argmax(cosines))
            preds.append(langs[best])
            scores.append(min(1.0, max(0.0, float(cosines[best]))))
            known.append(judge and _is_known(vector, n, best, profiles))
        names = [n for n in batch.schema.names if n != _JUDGED]
        kept = [batch.column(n) for n in names]
        added = {"lang_pred": pa.array(preds, pa.string()), "score": pa.array(scores, pa.float64())}
        if judge:
            added["known"] = pa.array(known, pa.bool_())
        yield pa.RecordBatch.from_arrays([*kept, *added.values()], names=[*names, *added])


_JUDGED = "text_to_judge"


def predict(documents: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str], seed: int = SEED,
            judge: bool = False, text_at: str = "") -> DataFrame:
    """The ``keep`` columns with lang_pred and score, and known if ``judge``.
    ``text_at`` names a struct of ``keep`` and the field of it that is the text
    (struct.field), so that the text travels once."""
    langs, prototypes, profiles = model
    rows = documents.select(*keep, *([] if text_at else [F.col("text").alias(_JUDGED)]))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != _JUDGED)
    task = partial(_predict_task, langs=langs, prototypes=prototypes, profiles=profiles, seed=seed, text_at=text_at or _JUDGED,
                   judge=judge)
    return rows.mapInArrow(task, f"{types}, lang_pred string, score double" + ", known boolean" * judge)


def identify(documents: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED,
             keep: list[str] | None = None, judge: bool = False, text_at: str = "") -> DataFrame:
    """Learns from the rows outside the held-out fold, predicts all rows:
    ``keep`` columns (the id if not given), held_out, lang_pred, score, and
    known if ``judge``."""
    marked = documents.withColumn("held_out", F.coalesce(fold() == HELD_OUT, F.lit(False)))
    model = learn_prototypes(marked.where(~F.col("held_out")), dimensions, seed)
    return predict(marked, model, [*(keep or ["doc_id"]), "held_out"], seed, judge, text_at)
