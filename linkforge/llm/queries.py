"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import collocations, conversation_repair, embedding_dedup, exact_dedup, language_id, license_scan, line_dedup, mixing, oracles, packing, pii, simhash, url_filter
from .common import SPACE_CLASS, broadcast_if_small, read_table
from .token_rollup import TokenRollup


def op1_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_duplicates(read_table(spark, d, "embeddings"))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Documents without their source's boilerplate lines; copies of a page
    count as one."""
    cleaned = line_dedup.drop_boilerplate(read_table(spark, d, "documents"), distinct_pages=True)
    return cleaned.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op3_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    return language_id.identify(read_table(spark, d, "documents"))


def op4_pii(spark: SparkSession, d: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.find_pii(read_table(spark, d, "documents"))


def op5_simhash(spark: SparkSession, d: str) -> DataFrame:
    """SimHash fingerprint and near-copy component of every document."""
    return simhash.near_duplicates(read_table(spark, d, "documents")).drop("kept")


def op6_token_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Token totals after loading all documents, then one batch that deletes
    those labelled toxic and revises those of low quality to single spaces;
    that batch is delivered twice and counts once."""
    documents, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    rollup = TokenRollup(spark, scratch_path(spark, f"token-rollup-{uuid.uuid4().hex[:12]}"))
    fields = ["doc_id", "source", "lang", "text"]
    rollup.apply_batch("load", documents.select(*fields, F.lit("insert").alias("op")))
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marked = marked.where("toxic = 1 OR quality = 0")
    curated = (documents.select(*fields).join(broadcast_if_small(marked, marked.count(), 32), "doc_id")
                        .withColumn("op", F.when(F.col("toxic") == 1, "delete").otherwise("revise"))
                        .withColumn("text", F.regexp_replace("text", f"{SPACE_CLASS}+", " ")))
    for _ in range(2):
        rollup.apply_batch("curate", curated)
    return rollup.totals()


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The row each document's text is kept under."""
    return exact_dedup.exact_duplicates(read_table(spark, d, "documents"))


def op8_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    """Words the target mix takes from each document."""
    mixed = mixing.mix(read_table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_pack(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, d, "documents"))


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """Verdict of the url rules on every page."""
    judged = url_filter.filter_urls(read_table(spark, d, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op11_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """Licenses named or quoted in every document."""
    return license_scan.digest(license_scan.scan_licenses(read_table(spark, d, "documents"), keep=["doc_id"])).drop("spans")


def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return conversation_repair.repair_report(conversation_repair.damage(read_table(spark, d, "conversations")))


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    """Best phrases of every language of the documents."""
    return collocations.mine_collocations(read_table(spark, d, "documents"))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All stages of the corpus pipeline on the documents."""
    return corpus_pipeline.run(spark, d)


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_line_dedup, op3_language_id, op4_pii, op5_simhash, op6_token_rollup, op7_exact_dedup, op8_mix_sources, op9_pack, op10_url_filter, op11_license_scan, op12_conversation_repair, op13_collocations, pipeline)}
ORACLES = {"op2_line_dedup": oracles.OP2, "op7_exact_dedup": oracles.OP7, "op8_mix_sources": oracles.OP8, "op10_url_filter": oracles.OP10, "op11_license_scan": oracles.OP11, "op13_collocations": oracles.OP13}
