import os
import time
import zipfile


from fixture_views import fixed_parameters
from linkforge.plans.workspace import STATS_SCHEMA, Workspace


def _archive(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    lines = ["BOF PUBLIC"]
    for r in rows:
        f = [""] * 142
        for pos, v in r.items():
            f[pos] = v
        lines.append("|".join(f))
    with zipfile.ZipFile(os.path.join(folder, name), "w") as zf:
        zf.writestr(name[:-4] + ".dat", ("\n".join(lines) + "\n").encode("latin-1"))


def _rec(uei, name, city, zipc, poc="SMITH", url=""):
    # positions: 0 uei, 11 legal_name, 17 city, 18 state, 19 zip, 26 url, 32 naics, 48 poc last
    return {0: uei, 11: name, 17: city, 18: "VA", 19: zipc, 26: url, 32: "541511", 48: poc}


def test_stages_end_to_end(spark, tmp_dir):
    src = os.path.join(tmp_dir, "data")
    v2 = os.path.join(src, "Public V2")
    hist = os.path.join(src, "Public - Historical")
    _archive(hist, "SAM_PUBLIC_MONTHLY_2024_JAN_X.zip", [
        _rec("U1", "Acme Widgets Inc", "ARLINGTON", "22201"),
        _rec("U9", "Old Name LLC", "RESTON", "20190")])
    time.sleep(0.05)
    _archive(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [
        _rec("U1", "Acme Widgets Inc", "ARLINGTON", "22201"),
        _rec("U2", "ACME WIDGETS LLC", "ARLINGTON", "22201"),
        _rec("U3", "Acme Widgets Corp", "ARLINGTON", "22201-1234"),
        _rec("U4", "Zeta Labs", "DENVER", "80202", poc="JONES"),
        _rec("U5", "Zeta Labs Incorporated", "DENVER", "80202", poc="JONES", url="http://zeta.example"),
        _rec("U6", "Lonely Co", "BOISE", "83702", poc="DOE")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    # default mode loads the first monthly archive only
    counts = ws.ingest(src).first()
    assert (counts.total_rows, counts.snapshots, counts.unique_ueis) == (6, 1, 6)
    # everything else, incrementally: the historical archive is new, the monthly one is skipped
    counts = ws.ingest(src, mode="all").first()
    assert (counts.total_rows, counts.snapshots, counts.unique_ueis) == (8, 2, 7)
    assert ws.ingest(src, mode="all").first().total_rows == 8   # nothing new
    names = {r.uei: r.all_names for r in ws.table("uei_names").collect()}
    assert names["U9"] == ["old name"]
    latest = {r.uei: str(r.snapshot_date) for r in ws.table("registrations_latest").collect()}
    assert latest["U1"] == "2024-02-01" and latest["U9"] == "2024-01-01"

    bands = {r.weight_band: r.n_pairs for r in ws.link(threshold=2.0, params=fixed_parameters(), tf=False).collect()}
    assert sum(bands.values()) == ws.table("match_predictions").count() > 0
    stats = ws.cluster(threshold=5.0).first()
    groups = {}
    for r in ws.table("entity_clusters").collect():
        groups.setdefault(r.cluster_id, set()).add(r.uei)
    assert {"U1", "U2", "U3"} in groups.values() and {"U4", "U5"} in groups.values()
    assert stats.n_clusters == len(groups)
    hits = ws.search("acme").collect()
    assert {h.uei for h in hits} == {"U1", "U2", "U3"} and hits[0].cluster_size == 3
    fallback = ws.search("lonely").collect()
    assert [(h.uei, h.cluster_id) for h in fallback] == [("U6", None)]
    cid = ws.entity_cluster("U4").first().cluster_id
    assert {r.uei for r in ws.members(cid).collect()} == {"U4", "U5"}
    diag = ws.diagnose(cid)
    assert diag["weakest_edges"].count() == 1 and diag["names"].count() == 1
    card = {r.field: r.value for r in ws.entity("U5").collect()}
    assert card["entity_url"] == "http://zeta.example" and "dba_name" not in card
    # rebuild from a single explicit file
    counts = ws.ingest(files=[os.path.join(hist, "SAM_PUBLIC_MONTHLY_2024_JAN_X.zip")], rebuild=True).first()
    assert (counts.total_rows, counts.unique_ueis) == (2, 2)


def _registration_names(ws):
    return {(r.uei, str(r.snapshot_date)): r.legal_name for r in ws.table("registrations").collect()}


def test_stream_then_batch_keeps_history(spark, tmp_dir):
    src = os.path.join(tmp_dir, "data")
    v2 = os.path.join(src, "Public V2")
    _archive(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [_rec("U1", "One", "A", "1"), _rec("U2", "Two", "A", "1")])
    _archive(v2, "SAM_PUBLIC_UTF-8_MONTHLY_V2_20240201.ZIP", [_rec("U1", "Wrong", "A", "1")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    ws.ingest_stream(src, os.path.join(tmp_dir, "ckpt"), files_per_batch=5)
    stored = _registration_names(ws)
    assert stored == {("U1", "2024-02-01"): "One", ("U2", "2024-02-01"): "Two"}
    assert {r.uei for r in ws.table("registrations_latest").collect()} == {"U1", "U2"}
    other = os.path.join(src, "Public - Historical")
    _archive(other, "SAM_PUBLIC_MONTHLY_2024_JAN_X.zip", [_rec("U3", "Three", "A", "1")])
    ws.ingest(files=[os.path.join(other, "SAM_PUBLIC_MONTHLY_2024_JAN_X.zip")])
    assert _registration_names(ws) == stored | {("U3", "2024-01-01"): "Three"}
    assert ws.ingest(src, mode="all").first().total_rows == 3  # the streamed archive counts as loaded


def test_archive_without_rows_is_tried_again(spark, tmp_dir):
    v2 = os.path.join(tmp_dir, "data", "Public V2")
    os.makedirs(v2)
    name = os.path.join(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP")
    with zipfile.ZipFile(name, "w") as zf:
        zf.writestr("readme.txt", "x")
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    assert ws.ingest(os.path.join(tmp_dir, "data")).first().total_rows == 0
    _archive(v2, os.path.basename(name), [_rec("U1", "One", "A", "1")])
    assert ws.ingest(os.path.join(tmp_dir, "data")).first().total_rows == 1


def test_explicit_file_of_any_name_and_equal_base_names(spark, tmp_dir):
    _archive(os.path.join(tmp_dir, "a"), "X_20240201.zip", [_rec("U1", "Old", "A", "1")])
    _archive(os.path.join(tmp_dir, "b"), "X_20240201.zip", [{}, {}, _rec("U1", "New", "A", "1"), _rec("U2", "Two", "A", "1")])
    os.rename(os.path.join(tmp_dir, "a", "X_20240201.zip"), os.path.join(tmp_dir, "a", "X_20240201.bin"))
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    first, second = os.path.join(tmp_dir, "b", "X_20240201.zip"), os.path.join(tmp_dir, "a", "X_20240201.bin")
    ws.ingest(files=[first, second])
    # the later file's row wins although it stands on an earlier line
    assert _registration_names(ws) == {("U1", "2024-02-01"): "Old", ("U2", "2024-02-01"): "Two"}


def test_rebuild_drops_history_even_without_archives(spark, tmp_dir):
    v2 = os.path.join(tmp_dir, "data", "Public V2")
    _archive(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [_rec("U1", "One", "A", "1")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    ws.ingest(os.path.join(tmp_dir, "data"))
    empty = os.path.join(tmp_dir, "none")
    os.makedirs(empty)
    assert ws.ingest(empty, rebuild=True).first().total_rows == 0
    assert not ws.exists("registrations") and not ws.exists("registrations_latest")


def test_unreadable_table_raises_and_stays(spark, tmp_dir):
    import glob

    import pytest

    from linkforge.operators import tables

    path = os.path.join(tmp_dir, "t")
    rows = spark.createDataFrame([("U1", "2024-01-01", "a")], "uei string, snapshot_date string, x string")
    assert tables.write_upsert(spark, rows, path) == 1
    part = glob.glob(path + "/snapshot_date=*/part-*")[0]
    with open(part, "rb") as fh:
        body = fh.read()
    with open(part, "wb") as fh:
        fh.write(b"broken")
    spark.catalog.refreshByPath(path)
    with pytest.raises(Exception):
        tables.write_upsert(spark, rows.withColumn("x", rows.x), path)
    assert glob.glob(path + "/snapshot_date=*/part-*") == [part]
    with open(part, "wb") as fh:
        fh.write(body)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "STATIC")
    assert mode.upper() == "STATIC"


def test_lines_are_split_once(spark):
    import fixture_views as fixtures
    from linkforge.sources import delimited

    lines = fixtures.customer_lines(spark, "/root/testdata/sf0.001")
    stored = lines.limit(0).unionByName(lines)
    plan = delimited.parse_lines(spark.createDataFrame(stored.limit(3).collect(), stored.schema))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1


def test_incremental_clusters_and_full_predictions(spark, tmp_dir):
    src = os.path.join(tmp_dir, "data")
    _archive(os.path.join(src, "Public V2"), "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [
        _rec("U1", "Acme Widgets Inc", "ARLINGTON", "22201"), _rec("U2", "ACME WIDGETS LLC", "ARLINGTON", "22201"),
        _rec("U3", "Acme Widgets Corp", "RESTON", "22201"), _rec("U4", "Zeta Labs", "DENVER", "80202", poc="JONES"),
        _rec("U5", "Zeta Labs Incorporated", "DENVER", "80202", poc="JONES")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    # nothing loaded: nothing to link
    assert ws.link(params=fixed_parameters()).count() == 0 and not ws.exists("match_predictions")
    ws.ingest(src)

    def clusters():
        return sorted((r.cluster_id, r.uei, r.cluster_size) for r in ws.table("entity_clusters").collect())

    ws.link(threshold=-60.0, params=fixed_parameters(), tf=True)
    lean = {(r.uei_l, r.uei_r): round(r.match_weight, 6) for r in ws.table("match_predictions").collect()}
    ws.cluster(threshold=min(lean.values()))
    all_edges = clusters()
    ws.cluster(threshold=max(lean.values()), incremental=True)
    few = clusters()
    ws.cluster(threshold=max(lean.values()))
    assert few == clusters() != all_edges
    ws.cluster(threshold=min(lean.values()), incremental=True)
    assert clusters() == all_edges
    ws.link(threshold=-60.0, params=fixed_parameters(), full=True)
    full = ws.table("match_predictions")
    assert {(r.uei_l, r.uei_r): round(r.match_weight, 6) for r in full.collect()} == lean
    assert {"name_norm_l", "name_norm_r", "bf_name_norm", "tf_name_norm_l"} <= set(full.columns)


def test_empty_inputs_give_empty_results(spark, tmp_dir):
    v2 = os.path.join(tmp_dir, "data", "Public V2")
    _archive(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [_rec("U1", "", "A", "1"), _rec("U2", "", "B", "2")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    # nothing loaded, nothing linked
    assert ws.link().collect() == [] and ws.cluster().collect() == []
    # loaded, but no record has a name to match by
    ws.ingest(os.path.join(tmp_dir, "data"))
    before = ws.versions.head()["version"]
    assert ws.link().collect() == [] and ws.cluster().collect() == []
    assert ws.versions.head()["version"] == before and not ws.exists("match_predictions")
    assert ws.entity("U1").count() > 0 and ws.entity("none").count() == 0


def test_no_edge_above_threshold_keeps_clusters(spark, tmp_dir):
    v2 = os.path.join(tmp_dir, "data", "Public V2")
    _archive(v2, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [
        _rec("U1", "Acme Widgets Inc", "ARLINGTON", "22201"), _rec("U2", "ACME WIDGETS LLC", "ARLINGTON", "22201")])
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    ws.ingest(os.path.join(tmp_dir, "data"))
    ws.link(threshold=-100.0, params=fixed_parameters())
    assert ws.cluster(threshold=1e9).collect() == []
    stats = ws.cluster(threshold=-100.0)
    assert stats.dtypes == spark.createDataFrame([], STATS_SCHEMA).dtypes
    kept = sorted(ws.table("entity_clusters").select("cluster_id", "uei").collect())
    assert [r.uei for r in kept] == ["U1", "U2"]
    for incremental in (False, True):
        assert ws.cluster(threshold=1e9, incremental=incremental).first().n_clusters == 1
        assert sorted(ws.table("entity_clusters").select("cluster_id", "uei").collect()) == kept
    assert ws.members(999).count() == 0 and ws.edges(999).count() == 0 and ws.entity_cluster("none").count() == 0
    assert ws.diagnose(999)["weakest_edges"].count() == 0
