"""Embedding near-dedup (operator 1): iterative quantisation, multi-index
Hamming tables, rerank with the original vectors.

Codes. On a bounded sample (about ``SAMPLE`` vectors, chosen by a hash of
their id) PCA gives up to 64 directions and iterative quantisation a rotation of
them that brings projections close to the corners of the binary cube. Each bit
is cut at its median, so that ones and zeros balance, if that lies near the
origin (within ``NEAR_ORIGIN`` of the projections' root mean square), else
through the origin: there the angle of two vectors alone decides how many bits
differ. A median that a dense group or a vector common to all moves away would
cut through the group, or see only what is left without the common part.
``CODE_BYTES`` bytes of code come from as many rotations (of different random
starts) as are needed.

Retrieval. The code is cut into 16-bit substrings, one Hamming table each. Two
vectors meet in a table when their substrings differ in at most one bit. Then
one of the substring's two bytes is equal, so every vector is filed under each
byte of its code and looks, within that file, for others whose neighbouring
byte differs in at most one bit. Files larger than ``CELL_ROWS`` are cut into
cells of bounded size; each pair is judged in the first file where it meets.

Rerank. Every pair that meets is compared by cosine in double precision with
the original vectors, inside the same task. A link at
cosine 0.9 differs in 14 % of the bits on average and meets in at least one of
eight tables with probability 0.95, at 0.97 with 0.999; the tests measure it.

Output of a cell is linear in its vectors: each one's number of links and a
spanning forest, never the pairs. Equal vectors are one class with a count and
aren't compared with one another.

Vectors are compared with those of their own length, each length with a
quantiser of its own. They are scaled by a power of two first, so that no
square of a finite component is lost.

Edge cases: a vector that is null, empty, all zero or with null or non-finite
components, or without an id, links with nothing and keeps its row. Repeated rows are vectors each. Without a usable
vector every row stands alone; an empty table gives no rows. Extra columns are
ignored, labels too.

Scale: a vector is shuffled once for each byte of code with its components.
Files hold n / 256 vectors if bits are even; a dense group or a common part
makes some of them large, and their pairs are judged cell by cell; ``file_bytes`` = 2 files by 16
bits (32-bit substrings), with more code bytes for the same recall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import component_labels
from ..session import materialize
from .cells import deal_cells

THRESHOLD = 0.9
SAMPLE = 8192
CODE_BYTES = 16
FILE_BYTES = 1
NEAR_ORIGIN = 0.4
ITERATIONS = 30
CELL_ROWS = 2048
GROUP_ROWS = 20_000
SEED = 42
_BLOCK = 512
_POP = np.array([b.bit_count() for b in range(256)], np.uint8)


@dataclass
class Quantiser:
    """Unit vector -> code bytes: project, compare with the cuts."""

    projection: np.ndarray  # dimensions x bits
    cuts: np.ndarray

    def codes(self, units: np.ndarray) -> np.ndarray:
        return np.packbits(units @ self.projection > self.cuts, axis=1)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_quantiser(sample: np.ndarray, code_bytes: int = CODE_BYTES, iterations: int = ITERATIONS,
                  seed: int = SEED) -> Quantiser:
    """Iterative quantisation on a sample of vectors."""
    units = _units(sample.astype(np.float64))
    _, directions = np.linalg.eigh(units.T @ units)  # not centred: a common part belongs to the angle
    bits = min(64, units.shape[1])
    top = directions[:, ::-1][:, :bits]
    low = (units - units.mean(axis=0)) @ top
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(math.ceil(8 * code_bytes / bits)):
        rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
        for _ in range(iterations):
            corners = np.where(low @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(corners.T @ low)
            rotation = (u @ v).T
        parts.append(top @ rotation)
    projection = np.concatenate(parts, axis=1)[:, :8 * code_bytes]
    found = units @ projection
    medians = np.median(found, axis=0)
    near = np.abs(medians) <= NEAR_ORIGIN * np.sqrt((found ** 2).mean(axis=0))
    return Quantiser(projection, np.where(near, medians, 0.0))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (array of float or double, as given) of the vectors
    that can link."""
    v, kind = F.col("vector"), vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    fine = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"))
                   .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(fine))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    found = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(flat), -1)
    return np.ldexp(found, -np.frexp(np.abs(found).max(axis=1, initial=0.0))[1][:, None])


def draw(classes: DataFrame, sample: int, seed: int) -> DataFrame:
    """About ``sample`` vectors (all, if there are no more): those whose hash
    lies in the lowest part that the number of vectors calls for."""
    total, space = classes.count(), 1 << 40
    if total <= sample:
        return classes
    return classes.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(space)) < F.lit(space * sample // total))


def coded(classes: DataFrame, quantiser: Quantiser, file_bytes: int) -> DataFrame:
    """vec_id, copies, vector, code and files (a number for each file)."""
    n_files = len(quantiser.cuts) // 8 // file_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = quantiser.codes(_units(_matrix(batch.column(2))))
            spelt = codes.reshape(len(codes), n_files, file_bytes).astype(np.int64)
            value = sum(spelt[:, :, b] << 8 * b for b in range(file_bytes))
            files = (np.arange(n_files) << 8 * file_bytes) + value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(files.tolist(), pa.list_(pa.int64()))], names=["vec_id", "copies", "vector", "code", "files"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("vec_id", "copies", "vector").mapInArrow(
        run, f"vec_id bigint, copies bigint, vector {kind}, code binary, files array<bigint>")


def _meeting(differ: np.ndarray, file_bytes: int) -> np.ndarray:
    """(pairs, files): whether a pair meets in a file. ``differ``: differing
    bits of each code byte."""
    by_file = differ.reshape(len(differ), differ.shape[1] // file_bytes, file_bytes).sum(axis=2)
    return (by_file == 0) & (by_file[:, np.arange(by_file.shape[1]) ^ 1] <= 1)


def judge_cell(file: int, vectors: np.ndarray, codes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float,
               file_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (positions) between two parts of a file; the same array
    twice: within it."""
    within = left is right
    mate = file ^ 1
    near = codes[:, mate * file_bytes:(mate + 1) * file_bytes]
    norms = np.linalg.norm(vectors, axis=1)
    found_a, found_b = [], []
    for k in range(0, len(left), _BLOCK):
        rows = left[k:k + _BLOCK]
        differ = sum(_POP[near[rows, b][:, None] ^ near[right, b][None, :]] for b in range(file_bytes))
        i, j = np.nonzero(differ <= 1)
        a, b = rows[i], right[j]
        if within:
            a, b = a[i + k < j], b[i + k < j]
        for s in range(0, len(a), 65_536):
            x, y = a[s:s + 65_536], b[s:s + 65_536]
            keep = _meeting(_POP[codes[x] ^ codes[y]], file_bytes).argmax(axis=1) == file
            x, y = x[keep], y[keep]
            cosine = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norms[x] * norms[y])
            found_a.append(x[cosine >= threshold])
            found_b.append(y[cosine >= threshold])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def link_cells(coded_vectors: DataFrame, threshold: float = THRESHOLD, file_bytes: int = FILE_BYTES,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, links, null): vectors linked to a in one cell; (a, null, b): an
    edge of a cell's spanning forest."""
    entries = coded_vectors.select("vec_id", "copies", "vector", "code", F.explode("files").alias("file"))
    dealt = deal_cells(entries, "file", "vec_id", cell_rows, GROUP_ROWS)

    def run(group: pa.Table) -> pa.Table:
        ids, copies = group.column("vec_id").to_numpy(), group.column("copies").to_numpy()
        keys = [group.column(c).to_numpy() for c in ("file", "row", "col")]
        part = group.column("part").to_numpy()
        vectors = _matrix(group.column("vector"))
        codes = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        order = np.lexsort((ids, part, *keys[::-1]))
        cuts = np.flatnonzero(np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)) + 1
        of, links, to = [], [], []
        for cell in np.split(order, cuts):
            if len(cell) < 2:
                continue
            file, row, col = (int(k[cell[0]]) for k in keys)
            here = np.arange(len(cell))
            left = here if row == col else here[part[cell] == row]
            right = here if row == col else here[part[cell] == col]
            a, b = judge_cell(file >> 8 * file_bytes, vectors[cell], codes[cell], left, right, threshold, file_bytes)
            if not len(a):
                continue
            mult = copies[cell]
            degree = np.bincount(a, mult[b], len(cell)) + np.bincount(b, mult[a], len(cell))
            hit = np.flatnonzero(degree)
            roots = _roots(len(cell), a, b)
            tied = np.flatnonzero(roots != here)
            of += [ids[cell[hit]], ids[cell[tied]]]
            links += [degree[hit].astype(np.int64).tolist(), [None] * len(tied)]
            to += [[None] * len(hit), ids[cell[roots[tied]]].tolist()]
        none = np.zeros(0, np.int64)
        return pa.table({"a": pa.array(np.concatenate([none, *of])), "links": pa.array([x for y in links for x in y], pa.int64()),
                         "b": pa.array([x for y in to for x in y], pa.int64())})

    return dealt.groupBy("group").applyInArrow(run, "a bigint, links bigint, b bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, code_bytes: int = CODE_BYTES,
                    file_bytes: int = FILE_BYTES, cell_rows: int = CELL_ROWS, seed: int = SEED,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = materialize(usable(vectors, id_col, vector_col), "embedding-rows")
    classes = materialize(rows.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")),
                          "embedding-classes")
    lengths = [r["length"] for r in classes.select(F.size("vector").alias("length")).distinct().collect()]
    found = vectors.sparkSession.createDataFrame([], "a bigint, links bigint, b bigint")
    for length in sorted(lengths):
        of_length = classes.where(F.size("vector") == length)
        drawn = draw(of_length.select("vec_id", "vector"), sample, seed).toArrow()
        quantiser = fit_quantiser(_matrix(drawn.column("vector")), code_bytes, seed=seed)
        table = materialize(coded(of_length, quantiser, file_bytes), "embedding-codes")
        cells = materialize(link_cells(table, threshold, file_bytes, cell_rows), "embedding-links")
        found = cells if found.isEmpty() else found.unionByName(cells)
    degree = found.where(F.col("links").isNotNull()).groupBy(F.col("a").alias("vec_id")).agg(F.sum("links").alias("links"))
    labels = component_labels(found.where(F.col("b").isNotNull()).select("a", "b"), "a", "b")
    answer = materialize(classes.join(degree, "vec_id", "left")
                                .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
                                .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                        F.coalesce("label", "vec_id").alias("component_id")), "embedding-answer")
    member = rows.join(answer, "vector").select(F.col("vec_id").alias("of"), "n_links", "component_id")
    every = vectors.select(F.col(id_col).alias("vec_id"))
    # ids may repeat: one answer per id, the linked vector's before a lone one's
    member = member.groupBy("of").agg(F.max(F.struct("n_links", "component_id")).alias("m"))
    return (every.join(member, every["vec_id"] == member["of"], "left")
                 .select("vec_id", F.coalesce("m.n_links", F.lit(0)).alias("n_links"),
                         F.coalesce("m.component_id", "vec_id").alias("component_id"))
                 .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
