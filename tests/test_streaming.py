"""Live intent sessions against the batch, over restarts; a sink that a replayed batch leaves alone."""

import os

from conftest import SMALL, as_set
from pyspark.sql import functions as F

from cartsight.operators.sessions import sessions_by_intent
from cartsight.sources import fixtures
from cartsight.sources.tables import new_folder
from cartsight.streaming import online as T

LAST = 1_800_000_000_000_000


def parts(spark):
    """The events in two files by time, and a late sentinel that lets the watermark pass all of them."""
    clicks = fixtures.clickstream(spark, SMALL).select("event_id", "user_id", "us", "timestamp", "event_type")
    middle = clicks.agg(F.expr("percentile_approx(us, 0.5)")).first()[0]
    sentinel = clicks.limit(1).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), F.lit(LAST).alias("us"),
        F.timestamp_micros(F.lit(LAST)).alias("timestamp"), F.lit("view").alias("event_type"))
    return clicks, [clicks.where(F.col("us") < middle), clicks.where(F.col("us") >= middle).unionByName(sentinel)]


def test_live_intent_sessions_equal_the_batch_over_a_restart(spark):
    clicks, files = parts(spark)
    folder, out, state = (new_folder(spark, n) for n in ("live", "out", "state"))
    seen = []
    for rows in files:  # the second run starts from the checkpoint of the first
        rows.coalesce(1).write.mode("append").parquet(folder)
        with T.rocksdb_state(spark):
            got = T.drain(T.intent_stream(T.read_stream(spark, folder, clicks.schema)), out, state)
        seen.append(got.count())
    assert 0 < seen[0] < seen[1] == clicks.count()
    batch = sessions_by_intent(clicks.withColumn("item_id", F.lit(1)))
    assert as_set(got, "event_id", "session_seq") == as_set(batch, "event_id", "session_seq")
    kind = F.col("event_type")
    whole = batch.groupBy("user_id", "session_seq").agg(
        F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count(F.lit(1)).alias("n_events"),
        F.count_if(kind == "view").alias("items_viewed"), F.count_if(kind == "scroll").alias("items_scrolled"),
        F.count_if(kind == "add_to_cart").alias("items_carted"),
        F.bool_or(kind.isin("purchase", "add_to_cart")).alias("closed")).where("closed").drop("closed")
    closed = T.intent_sessions(got)
    assert as_set(closed, *whole.columns) == as_set(whole, *whole.columns) and closed.count() > 20


def test_a_replayed_batch_changes_nothing(spark):
    clicks, files = parts(spark)
    folder, out, state = (new_folder(spark, n) for n in ("live", "out", "state"))
    for rows in files:
        rows.coalesce(1).write.mode("append").parquet(folder)
        T.replay_safe(T.read_stream(spark, folder, clicks.schema), out, state)
    before = as_set(spark.read.parquet(out), "batch", "event_id")
    assert len(before) == clicks.count() + 1 and {b for b, _ in before} == {0, 1}
    # the last batch was written, but the failure came before its commit
    commits = f"{state.removeprefix('file:')}/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    T.replay_safe(T.read_stream(spark, folder, clicks.schema), out, state)
    assert as_set(spark.read.parquet(out), "batch", "event_id") == before


def test_rows_sent_again_are_dropped(spark):
    clicks, _ = parts(spark)
    folder = new_folder(spark, "live")
    clicks.unionByName(clicks).coalesce(1).write.parquet(folder)
    live = T.read_stream(spark, folder, clicks.schema)
    got = T.replay_safe(live, new_folder(spark, "out"), new_folder(spark, "state"), ["event_id"], "timestamp")
    assert as_set(got, "event_id", "us") == as_set(clicks, "event_id", "us")
