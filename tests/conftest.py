import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("stratalake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only when the session has none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratalake-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratalake-test-")
