"""Versions of tables, the load journal and the derived tables that follow it."""

import os
import random

import pytest
from test_workspace import _archive, _rec, _registration_names

from linkforge.operators import tables
from linkforge.plans.versions import CommitConflict, TableVersions
from linkforge.plans.workspace import DERIVED, Workspace


def _frame(spark, rows):
    return spark.createDataFrame(rows, "uei string, x long")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_commit_swaps_tables_together_and_old_versions_stay_readable(spark, tmp_dir):
    v = TableVersions(spark, tmp_dir)
    first = v.commit(v.head(), {"a": v.write(_frame(spark, [("u", 1)]), "a"), "b": v.write(_frame(spark, [("u", 2)]), "b")})
    reader = v.read("a")
    second = v.commit(v.head(), {"a": v.write(_frame(spark, [("v", 3)]), "a"), "b": None})
    assert _rows(reader) == [("u", 1)] and _rows(v.read("a")) == [("v", 3)] and _rows(v.read("a", first)) == [("u", 1)]
    assert not v.exists("b") and v.entry(1) == first and v.numbers() == [1, 2] and second["version"] == 2
    with pytest.raises(FileNotFoundError):
        v.read("b")


def test_a_write_that_fails_changes_nothing(spark, tmp_dir):
    v = TableVersions(spark, tmp_dir)
    v.commit(v.head(), {"a": v.write(_frame(spark, [("u", 1)]), "a")})
    broken = spark.range(100).selectExpr("'u' AS uei", "CASE WHEN id < 99 THEN id ELSE raise_error('broken') END AS x")
    with pytest.raises(Exception):
        v.commit(v.head(), {"a": v.write(broken, "a")})
    assert _rows(v.read("a")) == [("u", 1)] and v.head()["version"] == 1


def test_the_second_of_two_writers_is_refused(spark, tmp_dir):
    v = TableVersions(spark, tmp_dir)
    base = v.head()
    v.commit(base, {"a": v.write(_frame(spark, [("u", 1)]), "a")})
    with pytest.raises(CommitConflict):
        v.commit(base, {"a": v.write(_frame(spark, [("u", 2)]), "a")})
    assert _rows(v.read("a")) == [("u", 1)] and v.numbers() == [1]


def test_partitions_are_replaced_one_by_one(spark, tmp_dir):
    v = TableVersions(spark, tmp_dir)
    frame = lambda rows: spark.createDataFrame(rows, "uei string, day string")
    base = v.commit(v.head(), {"t": v.write_partitions(frame([("a", "2024-01-01"), ("b", "2024-02-01"), ("n", None)]), "t", "day", [])})
    v.commit(base, {"t": v.write_partitions(frame([("c", "2024-02-01")]), "t", "day", base["tables"]["t"])})
    assert sorted(((r.uei, str(r.day)) for r in v.read("t").collect())) == [("a", "2024-01-01"), ("c", "2024-02-01"), ("n", "None")]
    assert len(v.head()["tables"]["t"]) == 3


def test_clean_up_keeps_the_last_versions(spark, tmp_dir):
    v = TableVersions(spark, tmp_dir)
    for i in range(4):
        v.commit(v.head(), {"a": v.write(_frame(spark, [("u", i)]), "a")})
    v.write(_frame(spark, [("never", 9)]), "a")
    assert v.clean_up(keep=2) == 3 and v.numbers() == [3, 4]
    assert _rows(v.read("a")) == [("u", 3)] and _rows(v.read("a", v.entry(3))) == [("u", 2)]


def _two_archives_of_one_date(tmp_dir):
    src = os.path.join(tmp_dir, "data")
    _archive(os.path.join(src, "Public V2"), "SAM_PUBLIC_MONTHLY_V2_20251101.ZIP", [_rec("A", "V2 A", "X", "1"), _rec("B", "V2 B", "X", "1")])
    _archive(os.path.join(src, "Public - Historical"), "SAM_PUBLIC_MONTHLY_2025_NOV_X.zip", [_rec("A", "Old A", "X", "1"), _rec("B", "Old B", "X", "1")])
    return src


def test_loading_again_changes_nothing(spark, tmp_dir):
    src = _two_archives_of_one_date(tmp_dir)
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    ws.ingest(src, mode="all")
    names, version = _registration_names(ws), ws.versions.head()["version"]
    assert set(names.values()) == {"Old A", "Old B"}
    for _ in range(3):
        ws.ingest(src, mode="all")
        assert _registration_names(ws) == names
    assert ws.versions.head()["version"] == version
    journal = {r["name"]: (r["status"], r["position"], r["load"]) for r in ws.table("load_journal").collect()}
    assert journal == {"SAM_PUBLIC_MONTHLY_V2_20251101.ZIP": ("loaded", 1, 1), "SAM_PUBLIC_MONTHLY_2025_NOV_X.zip": ("loaded", 2, 1)}
    assert ws.ingest_stream(src, os.path.join(tmp_dir, "ckpt"), files_per_batch=5) == 1
    assert _registration_names(ws) == names and ws.versions.head()["version"] == version


def test_a_failed_rebuild_of_derived_tables_is_made_up_for(spark, tmp_dir, monkeypatch):
    src = _two_archives_of_one_date(tmp_dir)
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))

    def fail(*_):
        raise RuntimeError("lost")

    build = DERIVED["uei_names"]
    monkeypatch.setitem(DERIVED, "uei_names", (fail, fail, None))
    with pytest.raises(RuntimeError):
        ws.ingest(src, mode="all")
    assert ws.table("registrations").count() == 2 and not ws.exists("registrations_latest")
    monkeypatch.setitem(DERIVED, "uei_names", build)
    ws.ingest(src, mode="all")  # nothing new to load
    assert {r["uei"] for r in ws.table("registrations_latest").collect()} == {"A", "B"} and ws.table("uei_names").count() == 2
    assert not ws.build_derived()


def test_a_failed_load_or_rebuild_leaves_the_tables_and_is_repeated(spark, tmp_dir, monkeypatch):
    src = _two_archives_of_one_date(tmp_dir)
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    ws.ingest(src, mode="first")
    names = _registration_names(ws)
    commit = TableVersions.commit
    for rebuild in (False, True):
        with monkeypatch.context() as m:
            m.setattr(TableVersions, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("store is away")))
            with pytest.raises(OSError):
                ws.ingest(src, mode="all", rebuild=rebuild)
        assert _registration_names(ws) == names and ws.table("registrations_latest").count() == 2
    assert TableVersions.commit is commit
    ws.ingest(src, mode="all")
    assert set(_registration_names(ws).values()) == {"Old A", "Old B"}


def test_derived_tables_follow_random_loads(spark, tmp_dir):
    rng = random.Random(7)
    ws = Workspace(spark, os.path.join(tmp_dir, "ws"))
    for load in range(4):
        folder = os.path.join(tmp_dir, f"load{load}")
        rows = [_rec(f"U{rng.randrange(12)}", rng.choice(["Alpha Inc", "Beta LLC", "", "Gamma"]), rng.choice(["X", "Y", ""]),
                     rng.choice(["22201", "", "80202-1234"])) for _ in range(8)]
        name = f"SAM_PUBLIC_MONTHLY_V2_2024{1 + load % 3:02d}01_{load}.ZIP"
        _archive(folder, name, rows)
        ws.ingest(files=[os.path.join(folder, name)])
        registrations = ws.table("registrations")
        for table, (build, _, _) in DERIVED.items():
            full = build(registrations)
            assert sorted(map(repr, ws.table(table).select(*full.columns).collect())) == sorted(map(repr, full.collect())), (load, table)
    assert ws.versions.head()["facts"] == {"load": 4, "derived": 4}
    assert not any(n.startswith("load_changes") for n in ws.versions.head()["tables"])


def test_refreshed_keys_may_vanish(spark):
    old = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "uei string, all_names array<string>")
    history = spark.createDataFrame([("a", "x"), ("b", None)], "uei string, name_norm string")
    touched = spark.createDataFrame([("b",), ("c",)], "uei string")
    assert [(r.uei, r.all_names) for r in tables.refresh_names(old, history, touched).collect()] == [("a", ["x"])]
