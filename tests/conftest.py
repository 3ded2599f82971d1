import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from linkforge.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a private checkpoint folder when the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lf-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lf-test-")
