import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sensorlake.session import configure
    s = (SparkSession.builder.master("local[4]").appName("sensorlake-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sensorlake-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="sensorlake-test-")
