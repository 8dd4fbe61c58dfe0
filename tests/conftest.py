import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

pyspark = pytest.importorskip("pyspark")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from staywise.session import BASE_CONF
    b = (SparkSession.builder.master("local[*]").appName("staywise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="staywise-test-ckpt-")))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()
