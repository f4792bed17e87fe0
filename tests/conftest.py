from __future__ import annotations

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

    from percepta.session import DEFAULT_CONF

    builder = SparkSession.builder.master("local[*]").appName("percepta-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests have no cluster folder: give the session a private one.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="percepta-tests-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="percepta-out-")


@pytest.fixture(scope="session")
def fixture_small(spark):
    from percepta.sources.fixture import passengers

    return passengers(spark, SF_SMALL)
