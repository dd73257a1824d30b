import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ratecraft.session import DEFAULT_CONF, checkpoint_dir
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # sets a private folder only when the session has none
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]
