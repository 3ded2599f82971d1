"""Views that map the driver's generic tables onto the registration data
model, so every operator runs on real, scale-growing input.

``entity_view``  (E): one registration per ``part`` row, planted groups of
                 four near-duplicates (same text runs on DuckDB).
``history_view`` (H): a multi-snapshot registration history over ``orders``.
The SQL text is shared with the oracle so both sides start from the same rows.
"""

from __future__ import annotations

import io
import zipfile
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkforge.functions import text
from linkforge.model_params import ParameterSet, level_params
from linkforge.operators import blocking, comparisons, scoring, search_index
from linkforge.plans.linkage import cluster_stage, link_records, prediction_stage, reaching_pairs
from linkforge.session import materialize, work_partitions
from linkforge.settings import DEFAULT_CLUSTER_THRESHOLD, DEFAULT_PREDICT_THRESHOLD, LinkSettings

ENTITY_SQL = """
SELECT lpad(CAST(p.p_partkey AS STRING), 12, '0') AS uei,
       CASE WHEN p.p_partkey % 101 = 0 THEN NULL
            ELSE upper(CASE WHEN p.p_partkey % 7 = 0 THEN p.p_name ELSE q.p_name END)
              || CASE p.p_partkey % 6 WHEN 0 THEN ' INC' WHEN 1 THEN ', Inc.' WHEN 2 THEN ' L.L.C.'
                 WHEN 3 THEN ' Company' WHEN 4 THEN '' ELSE ' Corp.' END END AS legal_name,
       CASE WHEN p.p_partkey % 3 = 0 THEN upper(q.p_name) END AS dba_name,
       lpad(CAST(q.p_size AS STRING), 5, '0')
         || CASE WHEN p.p_partkey % 3 = 0 THEN '-1234' ELSE '' END AS phys_zip,
       CASE WHEN p.p_partkey % 5 = 0 THEN p.p_brand ELSE q.p_brand END AS phys_city,
       'S' || CAST(q.p_size % 10 AS STRING) AS phys_state,
       CASE WHEN q.p_partkey % 12 = 0 AND p.p_partkey % 2 = 0
            THEN 'http://e' || CAST(q.p_partkey AS STRING) || '.example' END AS entity_url,
       'N' || CAST(q.p_partkey % 25 AS STRING) AS primary_naics,
       CASE WHEN p.p_partkey % 8 <> 0 THEN 'POC' || CAST((q.p_partkey * 13) % 97 AS STRING) END AS gov_poc_last,
       CASE WHEN p.p_partkey % 11 = 0 THEN 'C' || CAST(p.p_partkey % 99 AS STRING) END AS cage_code,
       q.p_type AS entity_structure
FROM {part} p JOIN {part} q ON q.p_partkey = p.p_partkey - p.p_partkey % 4
"""

HISTORY_SQL = """
SELECT lpad(CAST(o_custkey AS STRING), 12, '0') AS uei,
       CAST(o_orderdate AS DATE) AS snapshot_date,
       o_orderkey AS line_no,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE lower(substr(o_orderpriority, 3)) END AS name_norm,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS phys_city,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE lpad(CAST(o_orderkey % 50 AS STRING), 5, '0') END AS zip5,
       'F' || CAST(year(o_orderdate) AS STRING) AS source_file
FROM {orders}
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw registration-like rows (before normalisation). The rows of ``part``
    are spread first, since a small file is read by one task, which would
    normalise all names."""
    return spark.sql(ENTITY_SQL, part=read_table(spark, sf_dir, "part").repartition(work_partitions(spark)))


def registrations_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E with the ingest-time computed columns: the latest registrations."""
    e = entity_view(spark, sf_dir)
    return (e.withColumn("name_norm", text.normalize_name("legal_name"))
             .withColumn("zip5", text.zip5("phys_zip"))
             .withColumn("name_first4", text.first4("name_norm"))
             .withColumn("initial_reg_date", F.lit(None).cast("string"))
             .withColumn("phys_addr1", F.lit(None).cast("string"))
             .withColumn("gov_poc_first", F.lit(None).cast("string")))


def link_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest registrations that have a name (the linkage input)."""
    return registrations_latest(spark, sf_dir).filter(F.col("name_norm").isNotNull())


def history_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(HISTORY_SQL, orders=read_table(spark, sf_dir, "orders"))


# Fixed m/u test parameters (our own test values, not trained), so that the
# scoring keys do not depend on training.
FIXED_LEVELS = {
    "name_norm": {4: (.75, .02), 3: (.12, .05), 2: (.06, .08), 1: (.04, .25), 0: (.03, .60)},
    "dba_name": {2: (.8, .02), 1: (.1, .05), 0: (.1, .93)},
    "phys_city": {1: (.6, .04), 0: (.4, .96)},
    "zip5": {1: (.7, .02), 0: (.3, .98)},
    "phys_state": {1: (.8, .1), 0: (.2, .9)},
    "entity_url": {1: (.6, .005), 0: (.4, .995)},
    "primary_naics": {1: (.5, .04), 0: (.5, .96)},
    "gov_poc_last": {1: (.5, .01), 0: (.5, .99)},
    "cage_code": {1: (.2, .0005), 0: (.8, .9995)},
    "entity_structure": {1: (.7, .17), 0: (.3, .83)},
}


def fixed_parameters(prior: float = 1e-4) -> ParameterSet:
    return ParameterSet(prior=prior, levels=level_params(FIXED_LEVELS))


# ----------------------------------------------------------------------
# Source fixtures. SQL text in the subset Spark SQL and DuckDB both run.

# Fields of a rendered snapshot line (position -> expression over customer).
CUSTOMER_FIELDS = {
    0: "CASE WHEN c_custkey % 17 = 0 THEN '   ' ELSE lpad(CAST(c_custkey AS STRING), 12, '0') END",
    3: "'K' || CAST(c_custkey % 50 AS STRING)",
    5: "'A'",
    7: "'2020' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '15'",
    11: "'  ' || c_name || CASE c_custkey % 5 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' "
        "WHEN 2 THEN ', Corp' WHEN 3 THEN '' ELSE ' Company' END || ' '",
    12: "CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) ELSE '' END",
    17: "c_mktsegment",
    18: "'S' || CAST(c_nationkey % 10 AS STRING)",
    19: "lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS STRING), 5, '0') "
        "|| CASE WHEN c_custkey % 2 = 0 THEN '-0001' ELSE '' END",
    26: "CASE WHEN c_custkey % 7 = 0 THEN 'http://c' || CAST(c_custkey AS STRING) || '.example' ELSE '' END",
    27: "'2L'",
    32: "lpad(CAST(c_custkey % 100 AS STRING), 6, '0')",
    48: "'POC' || CAST(c_custkey % 37 AS STRING)",
    121: "'E'",
}
LINES_SOURCE_FILE = "SAM_PUBLIC_MONTHLY_V2_20240101.ZIP"


def _line_sql(name_expr: str) -> str:
    fields = dict(CUSTOMER_FIELDS)
    fields[11] = name_expr
    head = " || '|' || ".join(fields.get(i, "''") for i in range(121))
    tail = ("CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN '|' || " + fields[121]
            + " ELSE '|' || " + fields[121] + " || '" + "|" * 20 + "' END")
    cr = "CASE WHEN c_custkey % 4 = 3 THEN chr(13) ELSE '' END"
    return f"{head} || {tail} || {cr}"


def customer_lines_sql(customer: str = "customer") -> str:
    src = f"'{LINES_SOURCE_FILE}'"
    main = _line_sql(CUSTOMER_FIELDS[11])
    dup = _line_sql("c_name || ' DUP'")
    return f"""
SELECT {src} AS source_file, CAST(0 AS BIGINT) AS line_no,
       'BOF PUBLIC V2 20240101 ' || CAST(count(*) AS STRING) AS raw FROM {customer}
UNION ALL SELECT {src}, CAST(c_custkey * 4 + 1 AS BIGINT), {main} FROM {customer}
UNION ALL SELECT {src}, CAST(c_custkey * 4 + 2 AS BIGINT), {dup} FROM {customer} WHERE c_custkey % 11 = 0
UNION ALL SELECT {src}, CAST(c_custkey * 4 + 3 AS BIGINT), '!end' FROM {customer} WHERE c_custkey % 13 = 0
UNION ALL SELECT {src}, CAST(c_custkey * 4 + 4 AS BIGINT),
       CASE WHEN c_custkey % 2 = 0 THEN '' ELSE chr(13) END FROM {customer} WHERE c_custkey % 19 = 0
"""


def _line_col(name_expr: str):
    """The rendered line as ``concat_ws`` over a field array (compact
    generated code; the same text as the ``||`` chain of ``_line_sql``)."""
    fields = dict(CUSTOMER_FIELDS)
    fields[11] = name_expr
    arr = F.array(*[F.expr(fields.get(i, "''")) for i in range(142)])
    n = F.expr("CASE WHEN c_custkey % 10 = 0 THEN 121 WHEN c_custkey % 10 = 1 THEN 122 ELSE 142 END")
    cr = F.expr("CASE WHEN c_custkey % 4 = 3 THEN chr(13) ELSE '' END")
    return F.concat(F.concat_ws("|", F.slice(arr, F.lit(1), n)), cr)


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot lines rendered from ``customer``: a header, records of 142,
    122 and 121 fields, blank keys, repeated keys, '!end' and blank lines,
    trailing carriage returns. Same lines as ``customer_lines_sql``. Written
    once, as a load's files are: the parser's filters would else move below the
    rendering and render each line once for every mention of it. The rows of
    ``customer`` are spread first, since a small file is read by one task."""
    c = read_table(spark, sf_dir, "customer").repartition(work_partitions(spark))
    src = F.lit(LINES_SOURCE_FILE)
    key = F.col("c_custkey")
    header = c.agg(F.count(F.lit(1)).alias("n")).select(
        src.alias("source_file"), F.lit(0).cast("long").alias("line_no"),
        F.concat(F.lit("BOF PUBLIC V2 20240101 "), F.col("n").cast("string")).alias("raw"))
    main = c.select(src.alias("source_file"), (key * 4 + 1).cast("long").alias("line_no"),
                    _line_col(CUSTOMER_FIELDS[11]).alias("raw"))
    dup = c.where(key % 11 == 0).select(src.alias("source_file"), (key * 4 + 2).cast("long").alias("line_no"),
                                        _line_col("c_name || ' DUP'").alias("raw"))
    end = c.where(key % 13 == 0).select(src.alias("source_file"), (key * 4 + 3).cast("long").alias("line_no"),
                                        F.lit("!end").alias("raw"))
    blank = c.where(key % 19 == 0).select(src.alias("source_file"), (key * 4 + 4).cast("long").alias("line_no"),
                                          F.when(key % 2 == 0, F.lit("")).otherwise(F.lit("\r")).alias("raw"))
    lines = header.unionByName(main).unionByName(dup).unionByName(end).unionByName(blank)
    return materialize(lines, "customer-lines")


MONTH_CASE = "CASE mo " + " ".join(
    f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(text.MONTHS)) + " END"
V2_NAME = "'SAM_PUBLIC_MONTHLY_V2_' || CAST(y AS STRING) || lpad(CAST(mo AS STRING), 2, '0') || '01.ZIP'"
HIST_NAME = f"'SAM_PUBLIC_MONTHLY_' || CAST(y AS STRING) || '_' || {MONTH_CASE} || '_MODIFIED.zip'"


def listing_sql(orders: str = "orders") -> str:
    """(folder, name, y, mo): archive names for every month with orders."""
    return f"""
WITH m AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS mo FROM {orders})
SELECT 'Public V2' AS folder, {V2_NAME} AS name, y, mo FROM m WHERE mo % 2 = 1
UNION ALL SELECT 'Public - Historical', {HIST_NAME}, y, mo FROM m WHERE mo % 2 = 0
UNION ALL SELECT 'Public V2', 'SAM_PUBLIC_UTF-8_MONTHLY_V2_' || CAST(y AS STRING)
          || lpad(CAST(mo AS STRING), 2, '0') || '01.ZIP', y, mo FROM m WHERE mo % 3 = 0
UNION ALL SELECT 'Public - Historical', lower({V2_NAME}), y, mo FROM m WHERE mo = 11
UNION ALL SELECT 'Public - Historical', 'SAM_PUBLIC_MONTHLY_' || CAST(y AS STRING) || '_XYZ_EXTRACT.zip', y, mo
          FROM m WHERE mo = 6
UNION ALL SELECT 'Public V2', 'README_' || CAST(y AS STRING) || '.txt', y, mo FROM m WHERE mo = 9
"""


def loaded_sql(orders: str = "orders") -> str:
    """Registrations already loaded: orders before 1998 stamped with their
    month's archive name."""
    return f"""
SELECT o_orderkey, CASE WHEN mo % 2 = 1 THEN {V2_NAME} ELSE {HIST_NAME} END AS source_file
FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS mo FROM {orders}) o WHERE y < 1998
"""


def present_sql(listing: str = "listing", orders: str = "orders") -> str:
    """Files present locally: most months, some under a lower-cased name."""
    return f"""
SELECT CASE WHEN l.mo % 4 = 1 THEN lower(l.name) ELSE l.name END AS name,
       CAST(c.cnt * 1000 AS BIGINT) AS size_bytes
FROM {listing} l JOIN (SELECT year(o_orderdate) AS y, month(o_orderdate) AS mo, count(*) AS cnt
                       FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)) c
  ON c.y = l.y AND c.mo = l.mo
WHERE l.mo % 4 <> 0
"""


def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(listing_sql("{orders}"), orders=read_table(spark, sf_dir, "orders"))


def loaded_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(loaded_sql("{orders}"), orders=read_table(spark, sf_dir, "orders"))


def load_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded files as a journal; those with a 5 in their name gave no rows."""
    loaded = loaded_registrations(spark, sf_dir).select(F.col("source_file").alias("name")).distinct()
    status = F.when(F.col("name").contains("5"), "empty").otherwise("loaded")
    return loaded.select("name", status.alias("status"))


def present_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(present_sql("{listing}", "{orders}"), listing=archive_listing(spark, sf_dir),
                     orders=read_table(spark, sf_dir, "orders"))


def listing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON listing document per folder, in the service's nested shape."""
    listing = archive_listing(spark, sf_dir)
    entry = F.struct(
        F.concat(F.lit("Entity Registration/"), F.col("folder"), F.lit("/"), F.col("name")).alias("key"),
        F.col("name").alias("displayKey"),
        F.concat_ws("-", F.col("y").cast("string"), F.lpad(F.col("mo").cast("string"), 2, "0"),
                    F.lit("15")).alias("dateModified"))
    return (listing.groupBy("folder").agg(F.collect_list(entry).alias("items"))
                   .select("folder", F.to_json(F.struct(F.struct(F.col("items").alias(
                       "customS3ObjectSummaryList")).alias("_embedded"))).alias("json")))


# ----------------------------------------------------------------------
# Archives as bytes: ZIP files of Latin-1 lines, two of one snapshot date for
# every 5,000 customers; the second re-issues some of them under other names.

ARCHIVE_CUSTOMERS = 5_000
_REISSUED_NAME = "'Ünïted  ' || c_name || ' & Söhne ½ Co.'"


def archive_lines_sql(customer: str = "customer") -> str:
    """(load_pos, archive, line_no, raw)."""
    bucket = f"CAST(floor(c_custkey / {ARCHIVE_CUSTOMERS}.0) AS BIGINT)"
    return f"""
SELECT {bucket} * 2 + 1 AS load_pos, 'A' || CAST({bucket} AS STRING) || '_20240101.ZIP' AS archive,
       CAST(c_custkey AS BIGINT) AS line_no, {_line_sql(CUSTOMER_FIELDS[11])} AS raw FROM {customer}
UNION ALL SELECT {bucket} * 2 + 2, 'B' || CAST({bucket} AS STRING) || '_20240101.ZIP',
       CAST(c_custkey AS BIGINT), {_line_sql(_REISSUED_NAME)} FROM {customer} WHERE c_custkey % 7 = 0
"""


def _zip_archive(key: tuple, lines: pa.Table) -> pa.Table:
    load_pos, archive = (k.as_py() for k in key)
    rows = sorted(zip(lines.column("line_no").to_pylist(), lines.column("raw").to_pylist()))
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("readme.txt", "not a record")
        zf.writestr(archive[:-4] + ".DAT", "\n".join(["BOF PUBLIC", *(r for _, r in rows), "!end"]).encode("latin-1"))
    return pa.table({"load_pos": [load_pos], "path": ["/archives/" + archive], "content": pa.array([body.getvalue()], pa.binary())})


def customer_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(load_pos, path, content) as the binary file reader gives archives."""
    lines = spark.sql(archive_lines_sql("{customer}"), customer=read_table(spark, sf_dir, "customer"))
    return lines.groupBy("load_pos", "archive").applyInArrow(_zip_archive, "load_pos bigint, path string, content binary")


# Pages whose links carry classes and hidden spans: on even pages the file
# link class, on odd ones a longer word that only contains it.
CLASS_PAGES_SQL = """
SELECT page_id, url, replace(CASE WHEN page_id % 3 = 0 THEN
         replace(html, '</a>', '<span data-n="1" class="x sr-only">hidden</span></a>') ELSE html END,
         '<a href=', CASE WHEN page_id % 2 = 0 THEN '<a class="btn data-service-file-link" href='
                          ELSE '<a class="data-service-file-link-off" data-class="data-service-file-link" href=' END) AS html
FROM {pages}
"""


# Pages with markup that is broken or not to be read: an anchor in a comment, one
# in a script, stray end tags before the page, and after it an anchor with `>` in
# an attribute, a hidden element within one of its own name, an unclosed element
# and no end tag.
BROKEN_PAGES_SQL = """
SELECT page_id, concat('<!-- <a href="x">commented</a> --></b></a><script>"<a>scripted</a>"</script>', html,
                       '<a title="a>b"> tail <span class="x sr-only">hidden<span>too</span></span>', page_id, '<i> end') AS html
FROM {pages}
"""


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BROKEN_PAGES_SQL, pages=read_table(spark, sf_dir, "pages"))


def class_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLASS_PAGES_SQL, pages=read_table(spark, sf_dir, "pages"))


# ----------------------------------------------------------------------
# Fixture stages for the registered queries: E scored under the fixed
# parameters, memoised per application and data folder so that the many
# report queries share one materialised linkage.

@dataclass
class FixtureStages:
    spark: SparkSession
    sf_dir: str
    settings: LinkSettings = field(default_factory=LinkSettings)
    _cache: dict = field(default_factory=dict)

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def latest(self) -> DataFrame:
        # The stored latest-registrations table of the reference: written once,
        # read by every report (not re-derived from the source per query).
        return self._memo("latest", lambda: materialize(
            registrations_latest(self.spark, self.sf_dir), "registrations-latest"))

    def records(self, tf: bool = False) -> DataFrame:
        return self._memo(("records", tf), lambda: materialize(link_records(
            self.latest().where(F.col("name_norm").isNotNull()), self.settings, tf), "link-records"))

    def pairs(self) -> DataFrame:
        # Not written: pairs outnumber records by far, and each query reads a
        # few of their columns only.
        def build():
            keyed = self.records(True).select("*", *scoring.bound_columns(self.settings))
            return blocking.candidate_pairs(keyed, self.settings, carry=keyed.columns)
        return self._memo("pairs", build)

    def reaching(self, threshold: float = DEFAULT_PREDICT_THRESHOLD) -> DataFrame:
        """The pairs that can reach a threshold with term frequencies."""
        return self._memo(("reaching", threshold), lambda: reaching_pairs(
            self.records(True), fixed_parameters(), self.settings, threshold, tf=True))

    def gammas(self) -> DataFrame:
        # Not written either: as many rows as pairs, and each query reads them once.
        return self._memo("gammas", lambda: comparisons.lean_gammas(
            comparisons.gamma_vectors(self.pairs(), self.settings, keep_scores=False), self.settings))

    def scored(self, tf: bool = False, threshold: float | None = None) -> DataFrame:
        """Scored pairs: all, or those at or above a threshold."""
        if threshold is None:
            return self._memo(("scored", tf), lambda: materialize(scoring.score_pairs(
                self.gammas(), fixed_parameters(), self.settings, tf_adjust=tf), "scored"))
        return self._memo(("scored", tf, threshold), lambda: materialize(prediction_stage(
            self.records(True), fixed_parameters(), self.settings, threshold, tf), "scored"))

    def scoring_pass(self, threshold: float = DEFAULT_PREDICT_THRESHOLD, tf: bool = False) -> DataFrame:
        """The pairs at or above a threshold for a query that reads them once:
        not written, unless they are already, so that only the columns it
        takes are made."""
        written = self._cache.get(("scored", tf, threshold))
        return written if written is not None else self._memo(("pass", tf, threshold), lambda: prediction_stage(
            self.records(True), fixed_parameters(), self.settings, threshold, tf))

    def predictions(self, threshold: float = DEFAULT_PREDICT_THRESHOLD) -> DataFrame:
        return self.scored(threshold=threshold)

    def clustered(self, threshold: float = DEFAULT_CLUSTER_THRESHOLD):
        def build():
            clusters, edges = cluster_stage(self.edges(threshold), self.latest(), threshold, written=True)
            return materialize(clusters, "entity-clusters"), edges
        return self._memo(("clusters", threshold), build)

    def clusters(self, threshold: float = DEFAULT_CLUSTER_THRESHOLD) -> DataFrame:
        return self.clustered(threshold)[0]

    def search_index(self, table: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows, postings) of a searched table."""
        def build():
            rows = materialize(search_index.numbered_rows(table), "search-rows")
            return rows, materialize(search_index.postings(rows), "search-postings")
        return self._memo(("search", id(table)), build)

    def edges(self, threshold: float = DEFAULT_CLUSTER_THRESHOLD) -> DataFrame:
        def build():
            lowest = ("scored", False, DEFAULT_PREDICT_THRESHOLD)
            if lowest in self._cache and threshold >= DEFAULT_PREDICT_THRESHOLD:
                scored = self._cache[lowest]
            else:
                scored = prediction_stage(self.records(True), fixed_parameters(), self.settings, threshold)
            return materialize(scoring.edges_above(scored, threshold), "match-edges")
        return self._memo(("edges", threshold), build)


_STAGES: dict = {}


def fixture_stages(spark: SparkSession, sf_dir: str) -> FixtureStages:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _STAGES:
        _STAGES[key] = FixtureStages(spark, sf_dir)
    return _STAGES[key]
