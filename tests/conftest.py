import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartsight.params import SkewParams  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
# Cuts every user into pieces, so that the carry between pieces is exercised everywhere.
CUT_ALL = SkewParams(share=0.0005, min_rows=0, coarse=4, fine=3)
PLAIN = SkewParams()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, rows, user=1, item=1):
    """Events from (minute, type) or (minute, type, item) or (minute, type, item, user) tuples."""
    full = []
    for i, r in enumerate(rows):
        minute, kind, it, us = (*r, *(item, user)[len(r) - 2 :])
        full.append((i, us, int(minute * 60_000_000), kind, it, 1.0))
    schema = "event_id long, user_id long, us long, event_type string, item_id long, duration_seconds double"
    return spark.createDataFrame(full, schema)


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
