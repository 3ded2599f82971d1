"""License scans (operator 11): diagonal voting, in DataFrame functions only.

Every rolling word k-gram of a text is joined, by its 64-bit hash, to the
positions where the templates hold it; a joined gram is kept if its words are
the template's. It votes for a diagonal: its place in the text minus its place
in the template. A template copied word for word puts all its votes on one
diagonal; each word put in or left out moves what follows to a neighbouring
one. So

* base phrases and notices (k = 2) stand where all grams of the template vote
  for one diagonal;
* for bodies (k = 4) the votes of up to ``SHIFT`` diagonals after each one are
  merged. Of the merged diagonals within ``SHIFT`` of one another the one that
  covers most words stays (the first on ties). It is a span if the words covered are
  ``MIN_SHARE`` of the template and of the span's own length.

A span's score is covered words / (the longer of template and span): 1 for
phrases and notices.

Scale: grams stay in the task that reads the text; only votes for templates
leave it, combined by (text, template, diagonal) before the shuffle. Texts are
named by 128 bits of hash, so that copies of a text vote once however many rows
hold it, and the spans are joined back to the rows by that name (broadcast
behind a check of the measured size, else a join whose hot texts AQE can
split). The template index has one row per template gram, a fixed number; its
broadcast is checked all the same. A diagonal holds at most a template's length
of votes, and a frame of diagonals at most ``2 * SHIFT + 1`` of them, so no
group grows with the corpus; a text's list of spans grows with that text.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased.
Edge cases: null text is an empty one: no words, no spans, an empty list.
Repeated rows and null ids get their own row each. Extra columns are carried
along where ``keep`` names them; ``n_words`` and ``spans`` replace columns of
these names. Templates must be ASCII and at least k words long. An empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import broadcast_if_small
from .license_templates import TEMPLATES, Template

PHRASE_K = 2
BODY_K = 4
SHIFT = 3
MIN_SHARE = 0.8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The two letters outside ASCII whose lower case holds an ASCII letter.
FOLDING = ("\u0130", "\u212a")
SPAN = "struct<label:string,kind:string,first:bigint,last:bigint,score:double>"


def words_of(text: Column) -> Column:
    """Words of a text. lower() reaches beyond A-Z, which changes no word
    border and no ASCII word, but for the letters that fold into ASCII."""
    text = F.coalesce(text, F.lit(""))
    folds = F.contains(text, F.lit(FOLDING[0])) | F.contains(text, F.lit(FOLDING[1]))
    lowered = F.when(folds, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, NO_WORD), "")


def rolling_grams(texts: DataFrame) -> DataFrame:
    """The rows, which have ``words``, by rolling gram: ``k``, ``place`` (of its
    first word) and ``gram`` (hash). Grams that would run past the end hash
    fewer words and match nothing."""
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.xxhash64(a, b))
    longer = F.zip_with("pairs", F.slice("pairs", 3, F.size("words")), lambda a, b: F.xxhash64(F.lit(BODY_K), a, b))
    grams = texts.withColumn("pairs", pairs).select(*texts.columns, F.posexplode(F.concat("pairs", longer)).alias("i", "gram"))
    first = F.col("i") < F.size("words")
    return grams.select(*texts.columns, "gram", F.when(first, PHRASE_K).otherwise(BODY_K).alias("k"),
                        F.when(first, F.col("i")).otherwise(F.col("i") - F.size("words")).alias("place"))


def template_index(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """gram (hash), of (template number), at (place in it), gram_words."""
    rows = [(i, BODY_K if t.kind == "body" else PHRASE_K, t.text) for i, t in enumerate(templates)]
    listed = spark.createDataFrame(rows, "of int, template_k int, text string").select("of", "template_k", words_of(F.col("text")).alias("words"))
    grams = rolling_grams(listed).where("k = template_k AND place <= size(words) - k")
    return grams.select("gram", "of", F.col("place").alias("at"), F.slice("words", F.col("place") + 1, F.col("k")).alias("gram_words"))


def _text_name(text: str) -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(body).alias("name_a"), F.xxhash64(F.lit(1), body).alias("name_b")]


def diagonal_votes(docs: DataFrame, templates: Sequence[Template], text_col: str) -> DataFrame:
    """name_a, name_b, of, diagonal, at (the template places that voted)."""
    index = template_index(docs.sparkSession, templates)
    longest = max((len(t.text) for t in templates), default=0)
    index = broadcast_if_small(index, sum(len(t.text.split()) for t in templates), 64 + longest)
    read = docs.select(*_text_name(text_col), words_of(F.col(text_col)).alias("words"))
    same = F.slice("words", F.col("place") + 1, F.size("gram_words")) == F.col("gram_words")
    met = rolling_grams(read).join(index, "gram").where(same)
    return (met.groupBy("name_a", "name_b", "of", (F.col("place") - F.col("at")).alias("diagonal"))
               .agg(F.collect_set("at").alias("at")))


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text_col: str = "text") -> DataFrame:
    """name_a, name_b (of a text) and its spans, ordered by place and label."""
    spark = docs.sparkSession
    votes = materialize(diagonal_votes(docs, templates, text_col), "license-votes")
    sizes = [(i, t.label, t.kind, len(re.findall("[a-z0-9]+", t.text.lower()))) for i, t in enumerate(templates)]
    told = broadcast_if_small(spark.createDataFrame(sizes, "of int, label string, kind string, size int"), len(sizes), 64)
    votes = votes.join(told, "of")

    whole = (F.col("kind") != "body") & (F.size("at") == F.col("size") - (PHRASE_K - 1))
    exact = votes.where(whole).select("name_a", "name_b", "label", "kind", F.col("diagonal").cast("long").alias("first"),
                                      (F.col("diagonal") + F.col("size") - 1).cast("long").alias("last"), F.lit(1.0).alias("score"))

    by_diagonal = Window.partitionBy("name_a", "name_b", "of").orderBy("diagonal")
    after = by_diagonal.rangeBetween(0, SHIFT)
    covers = F.flatten(F.transform("at", lambda a: F.sequence(a, a + BODY_K - 1)))
    merged = (votes.where(F.col("kind") == "body")
                   .withColumn("start", F.min(F.col("diagonal") + F.array_min("at")).over(after))
                   .withColumn("end", F.max(F.col("diagonal") + F.array_max("at") + BODY_K - 1).over(after))
                   .withColumn("covered", F.size(F.array_distinct(F.flatten(F.collect_list(covers).over(after))))))
    rank = F.struct("covered", (-F.col("diagonal")).alias("early"))
    best = F.max(rank).over(by_diagonal.rangeBetween(-SHIFT, SHIFT)) == rank
    length = F.greatest(F.col("size"), F.col("end") - F.col("start") + 1)
    fuzzy = (merged.withColumn("best", best).where("best")
                   .select("name_a", "name_b", "label", "kind", F.col("start").cast("long").alias("first"),
                           F.col("end").cast("long").alias("last"), (F.col("covered") / length).alias("score"))
                   .where(F.col("score") >= MIN_SHARE))

    found = F.struct("first", "last", "label", "kind", "score")
    spans = exact.unionByName(fuzzy).groupBy("name_a", "name_b").agg(F.sort_array(F.collect_set(found)).alias("found"))
    ordered = F.transform("found", lambda s: F.struct(s["label"].alias("label"), s["kind"].alias("kind"), s["first"].alias("first"),
                                                      s["last"].alias("last"), s["score"].alias("score")))
    return spans.select("name_a", "name_b", ordered.alias("spans"))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text_col: str = "text",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) of every row, n_words of its text
    and its spans: label, kind, first and last word from 0, score."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "spans")]
    found = materialize(license_spans(docs, templates, text_col), "license-spans")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).first()
    found = broadcast_if_small(found, size["n"] + size["spans"], 96)
    rows = docs.select(F.struct(*keep).alias("row"), *_text_name(text_col),
                       F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
    joined = rows.join(found, ["name_a", "name_b"], "left")
    return joined.select("row.*", "n_words", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Per row: places of base phrases, labels, best score."""
    base = F.filter("spans", lambda s: s["kind"] == "base")
    starts = F.transform(base, lambda s: s["first"])

    def joined(spans: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return scanned.select(
        "*", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined("spans").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))
