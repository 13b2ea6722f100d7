import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lettermon.operators.materialize import checkpoint_root
    from lettermon.session import CONF

    b = SparkSession.builder.master("local[*]").appName("lettermon-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s
    s.stop()
