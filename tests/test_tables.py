import datetime as dt

from linkforge.operators import tables


def _h(spark, rows):
    return spark.createDataFrame(rows, "uei string, snapshot_date date, line_no long, name_norm string, "
                                       "phys_city string, zip5 string, source_file string")


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def test_dedupe_keep_last_and_latest(spark):
    df = _h(spark, [("a", D1, 1, "x", "c", "00001", "f"), ("a", D1, 5, "y", "c", "00001", "f"),
                    ("a", D2, 2, "z", None, "00002", "g"), ("b", D1, 3, None, "d", None, "f")])
    d = {(r.uei, r.snapshot_date): r.name_norm for r in tables.dedupe_keep_last(df).collect()}
    assert d == {("a", D1): "y", ("a", D2): "z", ("b", D1): None}
    latest = {r.uei: r.snapshot_date for r in tables.latest_per_key(tables.dedupe_keep_last(df)).collect()}
    assert latest == {"a": D2, "b": D1}
    names = {r.uei: r.all_names for r in tables.history_names(df).collect()}
    assert names == {"a": ["x", "y", "z"]}
    locs = {r.uei: r.all_locations for r in tables.history_locations(df).collect()}
    assert locs == {"a": ["c|00001", None]}


def test_upsert_and_partition_overwrite(spark, tmp_dir):
    old = _h(spark, [("a", D1, 1, "old", "c", "1", "f1"), ("b", D2, 2, "keep", "c", "1", "f1")])
    new = _h(spark, [("a", D1, 9, "new", "c", "1", "f2")])
    up = {r.uei: r.name_norm for r in tables.upsert_by_key(old, new).collect()}
    assert up == {"a": "new", "b": "keep"}
    path = f"{tmp_dir}/registrations"
    tables.write_upsert(spark, old, path)
    tables.write_upsert(spark, new, path)
    got = {r.uei: r.name_norm for r in spark.read.parquet(path).collect()}
    assert got == {"a": "new", "b": "keep"}


def test_counts(spark):
    df = _h(spark, [("a", D1, 1, "x", "c", "1", "f"), ("a", D2, 2, "y", "c", "1", "f"), ("b", D1, 3, "z", "c", "1", "f")])
    r = tables.ingest_counts(df).first()
    assert (r.total_rows, r.snapshots, r.unique_ueis) == (3, 2, 2)
