import os
import time
import zipfile

from linkforge.streaming.incremental import incremental_ingest


def _archive(folder, name, rows):
    lines = ["BOF HEADER"]
    for key, legal in rows:
        f = [""] * 142
        f[0], f[11], f[19] = key, legal, "12345"
        lines.append("|".join(f))
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr(name.rsplit(".", 1)[0] + ".dat", ("\n".join(lines) + "\n").encode("latin-1"))
    return path


def test_incremental_ingest_processes_new_archives_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "archives")
    os.makedirs(src)
    table = os.path.join(tmp_dir, "registrations")
    ckpt = os.path.join(tmp_dir, "stream-ckpt")
    _archive(src, "SAM_PUBLIC_MONTHLY_V2_20240101.ZIP", [("A1", "Alpha Inc"), ("B2", "Beta LLC")])
    time.sleep(1.1)
    _archive(src, "SAM_PUBLIC_MONTHLY_V2_20240201.ZIP", [("A1", "Alpha Renamed Inc")])
    assert incremental_ingest(spark, src, table, ckpt) == 2
    rows = {(r.uei, str(r.snapshot_date)): r.name_norm for r in spark.read.parquet(table).collect()}
    assert rows == {("A1", "2024-01-01"): "alpha", ("B2", "2024-01-01"): "beta",
                    ("A1", "2024-02-01"): "alpha renamed"}
    # Nothing new: no batch. A corrected re-issue of January replaces its rows.
    assert incremental_ingest(spark, src, table, ckpt) == 0
    time.sleep(1.1)
    _archive(src, "SAM_PUBLIC_MONTHLY_2024_JAN_FIXED.zip", [("B2", "Beta Fixed LLC")])
    assert incremental_ingest(spark, src, table, ckpt) == 1
    rows = {(r.uei, str(r.snapshot_date)): r.name_norm for r in spark.read.parquet(table).collect()}
    assert rows[("B2", "2024-01-01")] == "beta fixed"
    assert rows[("A1", "2024-01-01")] == "alpha"
