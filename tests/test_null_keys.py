"""Null keys: rows without a key take no part in shuffles by it, and keep a stated result."""

from conftest import as_set, frame
from pyspark.sql import functions as F

from cartsight.operators import sessions as S
from cartsight.operators.skew import broadcast_rows, join_lookup


def test_null_keys_are_spread_and_equal_the_plain_join(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("k"), "id").repartition(8)
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        got = join_lookup(rows, lookup, "k", how, max_broadcast_rows=0)
        assert as_set(got.na.fill(-1), "k", "id", "v") == as_set(rows.join(lookup, "k", how).na.fill(-1), "k", "id", "v")
    parts = join_lookup(rows, lookup, "k", max_broadcast_rows=0).where("k IS NULL").select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 1000


def test_broadcast_bound_counts_bytes(spark):
    narrow, wide = spark.range(1), spark.range(1).select(*(F.lit("x").alias(f"c{i}") for i in range(100)))
    assert broadcast_rows(narrow, 10**9) > broadcast_rows(wide, 10**9) > 1000
    assert broadcast_rows(narrow, 5) == 5


def test_events_without_a_user_have_no_session(spark):
    known = frame(spark, [(0, "view"), (31, "purchase"), (40, "view")])
    events = known.unionByName(frame(spark, [(0, "view"), (1, "view")], user=None).withColumn("event_id", F.col("event_id") + 100))
    for out in (S.sessions_by_gap(events), S.sessions_by_intent(events)):
        lost = out.where("user_id IS NULL")
        assert as_set(lost, "event_id") == [(100,), (101,)]
        assert lost.where("session_seq IS NULL AND session_id IS NULL AND session_start_us IS NULL").count() == 2
    assert as_set(S.sessions_by_gap(events).where("user_id IS NOT NULL"), "event_id", "session_seq") == [(0, 1), (1, 2), (2, 2)]
    starts = {r.event_id: r.starts for r in S.shifted_boundary(events).collect()}
    assert starts == {0: True, 1: False, 2: True, 100: None, 101: None}
    assert S.gap_to_previous(events).where("user_id IS NULL AND gap_us IS NULL").count() == 2
