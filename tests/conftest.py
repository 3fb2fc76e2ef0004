import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from liftlens.session import DEFAULT_CONF
    b = (SparkSession.builder.master("local[*]").appName("liftlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "6g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # use the configured shared folder; only when none is configured do tests make one
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="liftlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from liftlens.session import fresh_dir
    return fresh_dir(spark, "test")
