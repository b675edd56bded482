"""Sums of stored tables, within and beyond a long."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries


def repeated(spark, folder, times, out):
    """The events of a folder, ``times`` over with ids of their own."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    copies = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    copies.withColumn("event_id", F.col("event_id") + F.col("_copy") * 1_000_000).drop("_copy").write.parquet(f"{out}/events.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["s2_parquet_sink", "s3_csv_sink"])
def test_sums_beyond_a_long_are_exact(spark, tmp_path, name):
    once = {r["event_type"]: r for r in queries()[name](spark, MEDIUM).collect()}
    assert queries()[name](spark, SMALL).schema["sum_us"].dataType.typeName() == "long"
    many = queries()[name](spark, repeated(spark, MEDIUM, 10, tmp_path)).collect()
    assert {r["event_type"] for r in many} == set(once)
    for r in many:
        first = once[r["event_type"]]
        assert r["sum_us"] == Decimal(10 * int(first["sum_us"])) and r["sum_us"] > 1 << 63
        assert (r["n"], r["sum_item"]) == (10 * first["n"], 10 * first["sum_item"])
