import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from acqlens.session import ENGINE_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="acqlens-cp-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="acqlens-test-")
