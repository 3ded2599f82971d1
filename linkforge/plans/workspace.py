"""The four stages over a table root, as a user runs them.

A ``Workspace`` is a folder of Parquet tables (shared storage on a
cluster) holding what the stages hand to each other:

  registrations        all snapshots, partitioned by snapshot_date, key (uei, snapshot_date)
  load_journal         one row per archive read: name, path, size, position in its load,
                       loaded or empty, number of the load
  registrations_latest one row per uei
  uei_names            uei -> sorted distinct names
  uei_addresses        uei -> sorted distinct "city|zip5" (one NULL kept)
  match_predictions    scored candidate pairs >= the link threshold
  match_parameters     the trained m/u table
  entity_clusters      cluster membership + attributes + size
  match_edges          pairs >= the cluster threshold
  search_rows_*, search_postings_*   trigram index of the name search (``build_search_index``)

``ingest`` -> ``link`` -> ``cluster``, then the query methods read the
tables. Every step is a Spark job; the driver only sees counts, the
small parameter table and one row per archive.

Tables have versions (``versions``): each step stores what it makes in new
folders and commits them together at its end. A load commits the history, its
journal and the list of ueis it touched; the derived tables commit on their
own and say up to which load they go, so that a rebuild that failed is made
up for by the next ``ingest``, whether or not that loads anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model_params import ParameterSet
from ..operators import explore, graph, model, scoring, search_index, tables
from ..schema import REGISTRATION_SCHEMA
from ..session import ensure_checkpoint_dir, materialize
from ..settings import DEFAULT_CLUSTER_THRESHOLD, DEFAULT_PREDICT_THRESHOLD, LinkSettings
from ..sources import delimited, listing
from ..streaming import incremental
from . import linkage
from .versions import TableVersions

DERIVED = {
    "registrations_latest": (tables.latest_per_key, tables.refresh_latest, "uei"),
    "uei_names": (tables.history_names, tables.refresh_names, None),
    "uei_addresses": (tables.history_locations, tables.refresh_locations, None),
}
SEARCHED = ("entity_clusters", "registrations_latest")
STATS_SCHEMA = ("total_entities long, clustered long, clustered_pct double, singletons long, singletons_pct double, "
                "n_clusters long")
CHANGES = "load_changes"  # + number of the load: ueis it touched


class Workspace:
    def __init__(self, spark: SparkSession, root: str, settings: LinkSettings | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings or LinkSettings()
        ensure_checkpoint_dir(spark)
        self.versions = TableVersions(spark, self.root)

    # ------------------------------------------------------------ tables
    def exists(self, name: str) -> bool:
        return self.versions.exists(name)

    def table(self, name: str) -> DataFrame:
        return self.versions.read(name)

    # ------------------------------------------------------------ ingest
    def ingest(self, archive_root: str | None = None, mode: str = "first", files: list[str] | None = None,
               rebuild: bool = False) -> DataFrame:
        """Load archives not loaded before, upsert them, bring the derived
        tables up to date. ``mode``: 'first' (reference default), 'latest',
        'all'; ``files`` loads the given archive paths instead, in that order;
        ``rebuild`` starts from an empty history, which takes the place of the
        stored one when the load has succeeded.

        An archive counts as loaded by its name, once rows of it were read;
        one that gave no rows is tried again. All new archives are read in one
        job. Rows carry their archive's position in load order, so keep-last on
        (uei, snapshot_date) gives what loading them one after the other
        would; then one upsert rewrites only the touched snapshot partitions.
        Returns the summary (total rows, snapshots, unique ueis)."""
        base = self.versions.head()
        if rebuild:
            dropped = [n for n in base["tables"] if n in ("registrations", "load_journal", *DERIVED) or n.startswith(CHANGES)]
            base = {**base, "tables": {k: v for k, v in base["tables"].items() if k not in dropped},
                    "facts": {**base["facts"], "load": 0, "derived": 0}}
        if files:
            todo = self.spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in files], "path string, name string")
        else:
            todo = listing.source_file_select(listing.archive_paths(self.spark, archive_root), mode).select("path", "name")
        todo = listing.pending_archives(todo, self._journal(base))
        # One row per archive file, as many as Spark's own file index lists in the driver.
        paths = {r["path"] for r in todo.select("path").collect()}
        ordered = [p for p in files if p in paths] if files else [
            r["path"] for r in listing.load_ordered(todo).collect()]
        if ordered:
            stored = self.spark.read.format("binaryFile").load(ordered)
            self._load(base, stored, ordered)
        elif rebuild:
            self.versions.commit(base, {})
        self.build_derived()
        if not self.exists("registrations"):
            return tables.ingest_counts(self.spark.createDataFrame([], REGISTRATION_SCHEMA))
        return tables.ingest_counts(self.table("registrations"))

    def ingest_stream(self, archive_root: str, checkpoint_location: str, files_per_batch: int = 1) -> int:
        """Load the archives that arrived since the last run, one commit per
        micro-batch, by the journal that ``ingest`` uses. Returns the number of
        micro-batches."""
        def process(batch: DataFrame, batch_id: int) -> None:
            base = self.versions.head()
            named = listing.with_folder_and_name(batch.select("path")).where(~F.col("name").contains(listing.SKIP_MARKER))
            # One row per archive of the micro-batch (maxFilesPerTrigger).
            first: dict[str, str] = {}
            for r in listing.load_ordered(listing.pending_archives(named, self._journal(base)).select("path")).collect():
                first.setdefault(r["name"].lower(), r["path"])
            if first:
                self._load(base, batch, list(first.values()))
            self.build_derived()

        batches = incremental.run_stream(self.spark, archive_root, checkpoint_location, files_per_batch, process)
        self.build_derived()
        return batches

    def _journal(self, entry: dict) -> DataFrame:
        if "load_journal" in entry["tables"]:
            return self.versions.read("load_journal", entry)
        return self.spark.createDataFrame([], listing.JOURNAL_SCHEMA)

    def _load(self, base: dict, archives: DataFrame, ordered: list[str]) -> None:
        """Reads the ``ordered`` ones of ``archives`` (binaryFile rows), upserts
        their rows and commits history, journal and changes together."""
        position = delimited.load_position(ordered)
        sizes = archives.select(position.alias("position"), "path", "length").where("position > 0")
        listed = {r["position"]: r for r in sizes.collect()}  # one row per archive of this load
        files = archives.withColumn("load_pos", position).where("load_pos > 0")
        partitions = delimited.line_partitions(self.spark, sum(r["length"] for r in listed.values()))
        found = materialize(delimited.registrations_with_sources(delimited.unzip_lines(files, partitions)), "load-rows")
        gave = {r["load_pos"] for r in found.select(F.explode("sources").alias("load_pos")).distinct().collect()}
        load = base["facts"].get("load", 0) + 1
        read = self.spark.createDataFrame(
            [(p.rsplit("/", 1)[-1], p, listed[i]["length"] if i in listed else None, i, "loaded" if i in gave else "empty", load)
             for i, p in enumerate(ordered, 1)], listing.JOURNAL_SCHEMA).dropDuplicates(["name"])
        changed = {"load_journal": self.versions.write(listing.journal_after(self._journal(base), read), "load_journal")}
        if gave:
            incoming = found.drop("sources")
            stored, merged = base["tables"].get("registrations", []), incoming
            if stored:
                touched = incoming.select(F.col("snapshot_date").alias("touched_date")).distinct()
                current = self.versions.read("registrations", base).join(
                    touched, F.col("snapshot_date").eqNullSafe(F.col("touched_date")), "left_semi").select(*incoming.columns)
                merged = tables.upsert_by_key(current, incoming)
            changed["registrations"] = self.versions.write_partitions(merged, "registrations", "snapshot_date", stored)
            changed[f"{CHANGES}_{load}"] = self.versions.write(incoming.select("uei").distinct(), f"{CHANGES}_{load}")
        self.versions.commit(base, changed, {"load": load if gave else load - 1})

    def build_derived(self, full: bool = False) -> bool:
        """Brings the derived tables up to the last load: rows of the ueis that
        the loads since touched are computed anew, the others stay. ``full``
        computes all. Returns whether there was anything to do."""
        base = self.versions.head()
        load, derived = base["facts"].get("load", 0), base["facts"].get("derived", 0)
        if "registrations" not in base["tables"] or (derived == load and not full):
            return False
        registrations = self.versions.read("registrations", base)
        since = [f"{CHANGES}_{n}" for n in range(derived + 1, load + 1)]
        touched = None
        if not full and all(n in base["tables"] for n in [*since, *DERIVED]):
            touched = self.versions.read(since[0], base)
            for n in since[1:]:
                touched = touched.unionByName(self.versions.read(n, base))
            touched = materialize(touched.distinct(), "touched-ueis")
        changed: dict[str, list[str] | None] = {n: None for n in base["tables"] if n.startswith(CHANGES)}
        for name, (build, refresh, sort_by) in DERIVED.items():
            df = build(registrations) if touched is None else refresh(self.versions.read(name, base), registrations, touched)
            changed[name] = self.versions.write(df, name, sort_by)
        self.versions.commit(base, changed, {"derived": load})
        return True

    # -------------------------------------------------------------- link
    def link(self, threshold: float = DEFAULT_PREDICT_THRESHOLD, params: ParameterSet | None = None,
             tf: bool = True, full: bool = False) -> DataFrame:
        """Train (unless ``params``), score, keep pairs >= threshold. With
        ``full`` the stored predictions keep the compared values of both sides,
        the factors and the term frequencies too. Returns the weight-band
        summary, without rows where no registrations with a name are loaded;
        stored predictions then stay as they are."""
        if not self.exists("registrations_latest"):
            return self.spark.createDataFrame([], "weight_band string, n_pairs long")
        latest = self.table("registrations_latest")
        if latest.where(F.col("name_norm").isNotNull()).isEmpty():
            return self.spark.createDataFrame([], "weight_band string, n_pairs long")
        records = linkage.link_records(latest.where(F.col("name_norm").isNotNull()), self.settings, tf=tf)
        records = materialize(records, "link-records")
        if params is None:
            params = model.train(records, self.settings, listed=True)
        if full:
            if not tf:
                raise ValueError("full predictions hold term frequencies: they need tf=True")
            pairs = linkage.reaching_pairs(records, params, self.settings, threshold, tf=True)
            preds = linkage.full_predictions(pairs, params, self.settings, threshold)
        else:
            preds = linkage.prediction_stage(records, params, self.settings, threshold, tf)
        stored = {"match_parameters": self.versions.write(params.to_dataframe(self.spark), "match_parameters"),
                  "match_predictions": self.versions.write(preds, "match_predictions")}
        self.versions.commit(self.versions.head(), stored)
        return scoring.weight_bands(self.table("match_predictions"))

    # ----------------------------------------------------------- cluster
    def cluster(self, threshold: float = DEFAULT_CLUSTER_THRESHOLD, incremental: bool = False) -> DataFrame:
        """Connected components of pairs >= threshold. Returns statistics.
        ``incremental`` starts from the stored clusters and works on the edges
        that differ from the stored ones; the result is the same. Without
        predictions, or without one that reaches the threshold, stored
        clusters stay as they are and there are no statistics to return
        unless some are stored."""
        base = self.versions.head()
        preds = self.versions.read("match_predictions", base) if "match_predictions" in base["tables"] else None
        if preds is None or scoring.edges_above(preds, threshold).isEmpty():
            return self.stats() if "entity_clusters" in base["tables"] else self.spark.createDataFrame([], STATS_SCHEMA)
        stored = {"match_edges": self.versions.write(scoring.edges_above(preds, threshold), "match_edges", "uei_l")}
        edges = self.versions.read_folders("match_edges", stored["match_edges"])
        if incremental and {"match_edges", "entity_clusters"} <= set(base["tables"]):
            known = self.versions.read("entity_clusters", base).select("cluster_id", "uei")
            first = known.groupBy("cluster_id").agg(F.min("uei").alias("label"))
            labels = materialize(known.join(first, "cluster_id").select(F.col("uei").alias("node"), "label"), "stored-labels")
            changed = graph.change_edges(labels, self.versions.read("match_edges", base), edges)
            membership = graph.numbered_components(materialize(changed, "changed-labels"))
        else:
            membership = graph.connected_components(edges)
        clusters = graph.entity_clusters(membership, self.versions.read("registrations_latest", base))
        stored["entity_clusters"] = self.versions.write(clusters, "entity_clusters", "cluster_id")
        self.versions.commit(base, stored)
        return self.stats()

    # ----------------------------------------------------------- queries
    def stats(self) -> DataFrame:
        return explore.cluster_stats(self.table("entity_clusters"), self.table("registrations_latest"))

    def size_distribution(self) -> DataFrame:
        return explore.cluster_size_distribution(self.table("entity_clusters"))

    def largest(self, n: int = 10) -> DataFrame:
        return explore.largest_clusters(self.table("entity_clusters"), n)

    def overlink(self) -> DataFrame:
        return explore.overlink_check(self.table("entity_clusters"), self.table("registrations_latest"))

    def build_search_index(self) -> None:
        """Trigram indexes of the searched tables as they are now. ``search``
        uses them as long as those tables are the ones indexed."""
        base = self.versions.head()
        stored, of = {}, {}
        for name in SEARCHED:
            rows = search_index.numbered_rows(self.versions.read(name, base))
            written = self.versions.write(rows, f"search_rows_{name}", "row_no")
            index = search_index.postings(self.versions.read_folders(f"search_rows_{name}", written))
            stored[f"search_rows_{name}"] = written
            stored[f"search_postings_{name}"] = self.versions.write(
                index, f"search_postings_{name}", "gram", search_index.INDEX_OPTIONS)
            of[name] = base["tables"][name]
        self.versions.commit(base, stored, {"searched": of})

    def search(self, query: str, limit: int = 25) -> DataFrame:
        """Entities whose name contains the query, by the trigram index where
        it is up to date, else by a scan; the rows are the same."""
        base = self.versions.head()
        if base["facts"].get("searched") == {n: base["tables"].get(n) for n in SEARCHED}:
            parts = [self.versions.read(f"search_{kind}_{n}", base) for n in SEARCHED for kind in ("rows", "postings")]
            return search_index.indexed_name_search(*parts, query, limit)
        return explore.name_search(self.table("entity_clusters"), self.table("registrations_latest"), query, limit)

    def entity(self, uei: str) -> DataFrame:
        return explore.entity_card(self.table("registrations_latest"), uei)

    def entity_cluster(self, uei: str) -> DataFrame:
        return explore.entity_cluster(self.table("entity_clusters"), uei)

    def entity_members(self, uei: str, limit: int = 30) -> DataFrame:
        return explore.entity_members(self.table("entity_clusters"), uei, limit)

    def members(self, cluster_id: int, limit: int = 50) -> DataFrame:
        return explore.cluster_members(self.table("entity_clusters"), cluster_id, limit)

    def edges(self, cluster_id: int, limit: int = 20) -> DataFrame:
        return explore.cluster_edges(self.table("match_edges"), self.table("entity_clusters"), cluster_id, limit)

    def diagnose(self, cluster_id: int) -> dict[str, DataFrame]:
        clusters = self.table("entity_clusters")
        return {
            "size": explore.cluster_size(clusters, cluster_id),
            "weakest_edges": explore.weakest_edges(self.table("match_edges"), clusters,
                                                   self.table("registrations_latest"), cluster_id),
            "names": explore.cluster_name_counts(clusters, cluster_id),
            "cities": explore.cluster_city_counts(clusters, cluster_id),
        }

    def top_pairs(self, n: int = 10) -> DataFrame:
        return scoring.top_pairs(self.table("match_predictions"), n)

    def sample(self, n: int = 5) -> DataFrame:
        return tables.sample_latest(self.table("registrations_latest"), n)
