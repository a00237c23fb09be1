import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from periodlens.session import LOCAL_CONF, configure

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="periodlens-test-ckpt-"))
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="periodlens-test-wh-"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
