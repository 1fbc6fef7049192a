import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="shelfline-test-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", scratch)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.compare import duck_connect
    return duck_connect(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    from tests.compare import duck_connect
    return duck_connect(SF_CHECK)
