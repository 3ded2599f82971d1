"""Session helpers: building a session for local runs and resolving the
shared checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins at runtime (skew
# splitting, coalescing, broadcast only when the measured side is small).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "linkforge", extra: dict | None = None) -> SparkSession:
    """Session for tests, benches and local use. On a cluster the caller's
    own session is used instead and only ``ensure_checkpoint_dir`` matters."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (cluster setting).

    Only a local-mode session without one (tests) gets a private scratch
    folder; a cluster session without the setting is an error, never a
    fallback to machine-local disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # Stage tables must outlive executors: never a machine-local folder.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                               "for stage tables and lineage cuts")
        configured = tempfile.mkdtemp(prefix="linkforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", name) if "://" not in root else f"{root.rstrip('/')}/tables/{name}"


# Target output rows per task for pair-generating operators, and a ceiling.
ROWS_PER_WORK_PARTITION = 2_000_000
MAX_WORK_PARTITIONS = 100_000


def work_partitions(spark: SparkSession, expected_rows: float | None = None) -> int:
    """Partition count for operators whose output is much larger than their
    input (self-joins, explodes). AQE sizes partitions by shuffle *input*
    bytes, which for a pair-generating join would leave a few tasks producing
    millions of pairs each; so the count follows the expected OUTPUT
    (about 2M rows per task), never below the cluster's default parallelism.
    Without an estimate, the session's shuffle-partition setting is used."""
    floor = spark.sparkContext.defaultParallelism
    if expected_rows is None:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), floor)
    import math
    wanted = math.ceil(float(expected_rows) / ROWS_PER_WORK_PARTITION)
    return int(min(max(floor, wanted), MAX_WORK_PARTITIONS))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder is there. Any error but absence is raised."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Stage tables of a session stand in one folder of its own, so that they can
# be dropped together when their results have been written elsewhere.
_RUN_FOLDERS: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    import uuid

    key = spark.sparkContext.applicationId
    if key not in _RUN_FOLDERS:
        _RUN_FOLDERS[key] = scratch_path(spark, f"run-{uuid.uuid4().hex[:12]}")
    return _RUN_FOLDERS[key]


def drop_stage_tables(spark: SparkSession) -> None:
    """Deletes the stage tables this session has written. Frames that still
    read them become invalid, so call it after the last result is stored."""
    folder = _RUN_FOLDERS.pop(spark.sparkContext.applicationId, None)
    if folder:
        delete_path(spark, folder)


def materialize(df, label: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return the re-read table: lineage is cut, the result survives executor
    loss, and later reads get column pruning and filter pushdown. (Unlike
    ``checkpoint()``, the plan runs once and the re-read carries none of the
    original plan's constraints, which for large scoring expressions made
    every later filter expensive to optimise.)"""
    import uuid

    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
