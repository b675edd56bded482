import os
from dataclasses import replace

from conftest import MEDIUM, SMALL, as_set
from pyspark.sql import functions as F

from cartsight.operators.sessions import session_table, sessions_by_gap
from cartsight.params import ModelParams, Params, SessionParams
from cartsight.plans.run import run
from cartsight.plans.training import load_model
from cartsight.sources import fixtures
from cartsight.sources.tables import new_folder, read_table, run_folder, settle, table_counts, write_table
from cartsight.streaming import online as T


def test_a_whole_run_stores_every_stage(spark):
    quick = replace(ModelParams(), rounds=3, max_depth=3, max_iter=20)
    params = Params(session=SessionParams(480), model=quick)
    out = new_folder(spark, "run")
    events, catalog = fixtures.clickstream(spark, MEDIUM), fixtures.catalog(spark, MEDIUM)
    result = run(spark, events, catalog, params, out)
    counts = {r["split"]: r["count"] for r in result.features.groupBy("split").count().collect()}
    assert counts == {"train": 1184, "val": 82, "test": 133}
    assert {"sessionized_events", "split_events", "features", "models", "predictions"} <= set(
        os.listdir(out.removeprefix("file:")))
    assert result.metrics.select("model", "split").distinct().count() == 6
    model = load_model(f"{out}/models/boosted")
    stored = read_table(spark, f"{out}/features").drop("split").where("label >= 0")
    live = new_folder(spark, "live")
    stored.write.parquet(live)
    stream = T.score_stream_with_model(model, T.read_stream(spark, live, stored.schema), "boosted-1")
    scored = T.drain(stream, new_folder(spark, "out"), new_folder(spark, "state"))
    assert scored.count() == 1399 and scored.where("probability is null").count() == 0
    rerun = run(spark, events, catalog, params, out, train=False)  # overwrites its stages
    assert rerun.features.count() == 1399


def test_tables_round_trip(spark):
    df = fixtures.clickstream(spark, SMALL)
    path = new_folder(spark, "csv")
    write_table(df.select("event_id", "event_type"), path, fmt="csv", rows_per_file=300)
    parts = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]
    assert len(parts) >= 4
    assert spark.read.option("header", True).csv(path).count() == 1000
    stored = settle(df)
    assert stored.schema == df.schema and stored.exceptAll(df).count() == 0
    path = new_folder(spark, "parquet")
    write_table(df, path)
    write_table(df.limit(10), path)  # overwrites
    assert read_table(spark, path, df.schema).count() == 10
    assert as_set(table_counts({"a": df}), "table_name", "n_rows") == [("a", 1000)]


def test_a_run_folder_is_removed(spark):
    df = spark.range(10)
    with run_folder(spark) as folder:
        stored = settle(df)
        assert stored.count() == 10 and len(os.listdir(folder.removeprefix("file:"))) == 1
    assert not os.path.exists(folder.removeprefix("file:"))
    assert settle(df).count() == 10


def test_stream_sessions_equal_batch_sessions(spark):
    """Two files and a late sentinel that closes all sessions."""
    clicks = fixtures.clickstream(spark, SMALL).select("event_id", "user_id", "us", "timestamp", "event_type")
    sentinel = clicks.limit(1).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"),
        F.lit(1_800_000_000_000_000).alias("us"),
        F.timestamp_micros(F.lit(1_800_000_000_000_000)).alias("timestamp"), F.lit("view").alias("event_type"))
    folder = new_folder(spark, "live")
    clicks.coalesce(1).write.mode("append").parquet(folder)
    sentinel.coalesce(1).write.mode("append").parquet(folder)
    stream = T.read_stream(spark, folder, clicks.schema)
    closed = T.drain(T.session_stream(stream), new_folder(spark, "out"), new_folder(spark, "state"))
    batch = session_table(sessions_by_gap(clicks.withColumn("item_id", F.lit(1))))
    columns = ("user_id", "start_us", "end_us", "n_events", "has_purchase")
    assert as_set(closed.where("user_id >= 0"), *columns) == as_set(batch, *columns)


def test_stream_keeps_a_gap_of_exactly_the_threshold(spark):
    rows = [(1, 0), (1, 30), (1, 61), (1, 10_000)]
    df = spark.createDataFrame([(u, m * 60_000_000) for u, m in rows], "user_id long, us long")
    df = df.select("user_id", F.timestamp_micros("us").alias("timestamp"), F.lit("view").alias("event_type"))
    folder = new_folder(spark, "live")
    df.write.parquet(folder)
    stream = T.session_stream(T.read_stream(spark, folder, df.schema))
    closed = T.drain(stream, new_folder(spark, "out"), new_folder(spark, "state"))
    assert [r[0] for r in as_set(closed, "n_events")] == [1, 2]
