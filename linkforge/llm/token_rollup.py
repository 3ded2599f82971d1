"""Token counts (operator 6): delta-maintained rollups.

A ``TokenRollup`` is a folder of written tables:

- ``ledger``: for every batch the documents it touched with their new count
  (or as deleted); the last batch that names a document holds its state;
- ``deltas``: for every batch the signed sums by source, language and tokenizer
  version: what inserts add, deletes take away and revisions change;
- ``commits``: one entry per committed batch, written last.

Totals are the sum of the committed batches' deltas, so they are never counted
anew. A batch is idempotent: one already committed is skipped; one that failed
half-way left no commit entry, is not seen by readers, and writes the same
folders again when it is repeated.

A change names a document (``doc_id``), an ``op`` and, unless it deletes, the
new text, source and language. ``insert`` and ``revise`` both set the
document's state, ``delete`` ends it; what the document had before is looked
up in the ledger and taken away from the totals it was counted in, so a
document that moves to another source or language, or is counted by another
tokenizer version, leaves its former total. Several changes of one document
in a batch: the one with the highest ``change_no`` counts (equal: the highest
op by name, then the longer count).

Edge cases: null text counts 0 tokens; null source, language or id are values
like others; deleting an unknown document changes nothing; an empty batch
commits with no deltas. Extra columns are ignored, repeated rows are one
change. Very long texts are tokenised whole, in the scan's tasks; only narrow
rows are shuffled, by document id, and sums are combined in the tasks first,
so a hot source is a few rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokenizing import VOCABULARY, byte_bpe

VERSION = VOCABULARY.removesuffix(".json")
_KEYS = ["source", "lang", "tokenizer_version"]
_MOVES = ("inserted", "deleted", "revised")


def count_tokens(documents: DataFrame, tokenizer_path: str | None = None, text_col: str = "text") -> DataFrame:
    """The other columns with n_tokens; the text goes no further."""
    others = [c for c in documents.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer_path)
        for batch in batches:
            counts = [len(encode(t.as_py())) if t.is_valid else 0 for t in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*others, "n_tokens"])

    rows = documents.select(*others, text_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, n_tokens bigint")


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str, tokenizer_path: str | None = None, version: str = VERSION):
        self.spark, self.path, self.tokenizer_path, self.version = spark, path.rstrip("/"), tokenizer_path, version

    def _exists(self, name: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _commits(self) -> list[str]:
        """Committed batches in order. One row a batch."""
        if not self._exists("commits"):
            return []
        rows = self.spark.read.parquet(f"{self.path}/commits/*").select("seq", "batch").collect()
        return [r["batch"] for r in sorted(rows)]

    def _read(self, table: str) -> DataFrame | None:
        done = self._commits()
        if not done:
            return None
        # one path a batch, as a batch without a commit entry doesn't count
        return self.spark.read.parquet(*(f"{self.path}/{table}/{b}" for b in done))

    def _before(self, touched: DataFrame) -> DataFrame | None:
        """State before the batch of the documents it touches."""
        ledger = self._read("ledger")
        if ledger is None:
            return None
        ids = touched.select(F.col("doc_id").alias("touched_id"))
        rows = ledger.join(ids, ledger["doc_id"].eqNullSafe(ids["touched_id"]), "left_semi")
        last = rows.groupBy("doc_id").agg(F.max(F.struct("seq", "alive", *_KEYS, "n_tokens")).alias("s"))
        return last.select("doc_id", "s.*").where("alive")

    def _signed(self, new: DataFrame, before: DataFrame | None) -> DataFrame:
        """Rows of +1 or -1 documents and their tokens, and what moved them."""
        one, now = F.lit(1).cast("long"), new.where("alive")
        if before is None:
            return now.select(*_KEYS, F.lit("inserted").alias("move"), one.alias("docs"), F.col("n_tokens").alias("tokens"))

        def against(rows: DataFrame, others: DataFrame, alone: str) -> DataFrame:
            there = others.select(F.col("doc_id").alias("other_id"), F.lit(True).alias("both"))
            return (rows.join(there, rows["doc_id"].eqNullSafe(there["other_id"]), "left")
                        .withColumn("move", F.when(F.col("both"), "revised").otherwise(alone)))

        plus = against(now, before, "inserted").select(*_KEYS, "move", one.alias("docs"), F.col("n_tokens").alias("tokens"))
        minus = against(before, now, "deleted").select(*_KEYS, "move", (-one).alias("docs"), (-F.col("n_tokens")).alias("tokens"))
        return plus.unionByName(minus)

    def apply_batch(self, batch: str, changes: DataFrame) -> bool:
        """Commits the batch; False if it was committed before."""
        done = self._commits()
        if batch in done:
            return False
        seq = len(done)
        if "change_no" not in changes.columns:
            changes = changes.withColumn("change_no", F.lit(0).cast("long"))
        text = F.when(F.col("op") != "delete", F.col("text"))
        counted = count_tokens(changes.select("doc_id", "op", "change_no", "source", "lang", text.alias("text")),
                               self.tokenizer_path)
        last = counted.groupBy("doc_id").agg(F.max(F.struct("change_no", "op", "n_tokens", "source", "lang")).alias("s"))
        ledger = f"{self.path}/ledger/{batch}"
        (last.select("doc_id", F.lit(seq).cast("long").alias("seq"), (F.col("s.op") != "delete").alias("alive"),
                     "s.source", "s.lang", F.lit(self.version).alias("tokenizer_version"), "s.n_tokens")
             .write.mode("overwrite").parquet(ledger))
        new = self.spark.read.parquet(ledger)
        signed = self._signed(new, self._before(new))
        sums = [F.sum(F.when(F.col("move") == m, F.col("tokens")).otherwise(0)).alias(f"tokens_{m}") for m in _MOVES]
        (signed.groupBy(*_KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"), *sums)
               .write.mode("overwrite").parquet(f"{self.path}/deltas/{batch}"))
        (self.spark.createDataFrame([(seq, batch)], "seq bigint, batch string").coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/commits/{batch}"))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens and the tokens
        inserted, deleted and revised (signed) on the way there."""
        sums = ["n_docs", "n_tokens", *(f"tokens_{m}" for m in _MOVES)]
        deltas = self._read("deltas")
        if deltas is None:
            types = "source string, lang string, tokenizer_version string, " + ", ".join(f"{s} bigint" for s in sums)
            return self.spark.createDataFrame([], types)
        return deltas.groupBy(*_KEYS).agg(*(F.sum(s).alias(s) for s in sums))
