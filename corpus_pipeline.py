"""Training corpus: documents -> packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``:

1. language ID rejects documents without a language;
2. line dedup takes boilerplate lines of their source out of the texts, and
   documents of which no word is left;
3. SimHash near-dedup keeps the smallest doc_id of each group;
4. mixing draws the remaining words to the sources' target weights;
5. packing cuts the mix into token sequences.

All but the last return the columns of ``docs``. Extra columns travel along;
null texts are rejected by stage 1; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.llm import language_id, line_dedup, mixing, packing, simhash
from linkforge.llm.common import WORD
from linkforge.session import materialize


# Rows are whole documents here: so many of them travel to Python at once.
BATCH_ROWS = 1000


def _short_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to ``BATCH_ROWS`` where they are longer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language: not those without a letter, nor those
    whose 3-grams fit no learned language. The fit asked for grows with the
    number of 3-grams, so short clean texts stay."""
    _short_batches(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "lang", "text")
    return language_id.identify(rows, keep=["row"], judge=True, text_at="row.text").where("known").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines. Copies count as one
    page, so that the near-dedup stage still finds one of each group."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "source", "text")
    cleaned = line_dedup.drop_boilerplate(rows, distinct_pages=True)
    left = cleaned.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return left.select(*(changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group: the smallest doc_id, then the
    first row of the stored table."""
    _short_batches(spark)
    placed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text",
                         F.monotonically_increasing_id().alias("scan_row"))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "scan_row")
    kept = simhash.near_duplicates(placed.select(name.alias("doc_id"), "text")).where("kept")
    rows = kept.select(F.col("doc_id.scan_row").alias("kept_row"))
    return placed.join(rows, F.col("scan_row") == F.col("kept_row")).select("row.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken to reach the sources' targets."""
    _short_batches(spark)
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 2048 tokens."""
    _short_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

# Token ids and learned profiles have no SQL form; tests/llm compares the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
