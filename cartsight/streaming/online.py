"""Structured Streaming: gap and intent sessions of live events, scoring of live rows, and sinks that a replay leaves alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cartsight.functions.columns import one_if
from cartsight.operators.scoring import score_rows
from cartsight.params import ADD_TO_CART, INTENT_BOUNDARY, PURCHASE, SCROLL, VIEW, SessionParams
from cartsight.plans.training import predict


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """Parquet files as they arrive in a folder; ``only`` is a pattern on their names."""
    reader = spark.readStream.schema(schema)
    if only:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def session_stream(
    events: DataFrame,
    delay: str = "1 hour",
    params: SessionParams = SessionParams(),
    ts: str = "timestamp",
) -> DataFrame:
    """Closed sessions per user, each emitted once the watermark has passed its last event by the gap.

    As in batch, a gap of exactly the threshold stays inside the session.
    """
    gap = F.session_window(F.col(ts), f"{params.inactivity_minutes} minutes")
    return (
        events.withWatermark(ts, delay)
        .groupBy("user_id", gap.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.max(one_if(F.col("event_type") == PURCHASE)).alias("has_purchase"),
        )
        .select(
            "user_id",
            F.unix_micros("w.start").alias("start_us"),
            (F.unix_micros("w.end") - params.inactivity_minutes * 60_000_000).alias("end_us"),
            "n_events",
            "has_purchase",
        )
    )


# What a user's open intent session knows: its number, start and counts, and events that may still be preceded by others.
INTENT_STATE = """session_seq long, start_us long, n_events long, items_viewed long, items_scrolled long, items_carted long,
pending_us array<long>, pending_id array<long>, pending_type array<string>"""
INTENT_ROW = """user_id long, event_id long, us long, session_seq long, start_us long, n_events long, items_viewed long,
items_scrolled long, items_carted long, closes boolean"""


def intent_stream(events: DataFrame, delay: str = "1 hour", boundary: Sequence[str] = INTENT_BOUNDARY) -> DataFrame:
    """The intent session so far at every event, the event included; a boundary event ``closes`` its session.

    ``events`` has user_id, event_id, us, event_type and a timestamp. An event is answered once the watermark has passed it, in
    order of time and id among all that came by then; until then it waits in the state of its user, with a timer
    at the first that waits. The rows that close are the sessions of the batch.
    """
    kinds = {VIEW: 3, SCROLL: 4, ADD_TO_CART: 5}  # places of the counts in the state
    names = [f.split()[0] for f in INTENT_ROW.replace("\n", " ").split(",")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, start, n, viewed, scrolled, carted, *held = state.get if state.exists else (1, None, 0, 0, 0, 0, [], [], [])
        waiting = list(zip(*held))
        for rows in batches:
            waiting += zip(rows["us"].tolist(), rows["event_id"].tolist(), rows["event_type"].tolist())
        waiting.sort(key=lambda e: e[:2])
        mark = state.getCurrentWatermarkMs()
        open_, out, done = [seq, start, n, viewed, scrolled, carted], [], 0
        for us, event_id, kind in waiting:
            if us >= mark * 1000:
                break
            done += 1
            open_[1] = us if open_[2] == 0 else open_[1]
            open_[2] += 1
            if kind in kinds:
                open_[kinds[kind]] += 1
            out.append((key[0], event_id, us, *open_, kind in boundary))
            if kind in boundary:
                open_ = [open_[0] + 1, None, 0, 0, 0, 0]
        waiting = waiting[done:]
        state.update((*open_, *([e[k] for e in waiting] for k in range(3))))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000, mark + 1))
        if out:
            yield pd.DataFrame(out, columns=names)

    rows = events.select("user_id", "event_id", "us", "event_type", F.col("timestamp").alias("_at")).withWatermark("_at", delay)
    return rows.groupBy("user_id").applyInPandasWithState(step, INTENT_ROW, INTENT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def intent_sessions(rows: DataFrame) -> DataFrame:
    """The sessions that have closed, from the rows of ``intent_stream``."""
    return rows.where("closes").select(
        "user_id", "session_seq", "start_us", F.col("us").alias("end_us"), "n_events", "items_viewed", "items_scrolled", "items_carted"
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk beside the executor, and not in its heap."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def score_stream(
    rows: DataFrame, probability: Column, model_version: str, threshold: float = 0.5
) -> DataFrame:
    """The batch scoring row by row: no state, so it runs on a stream unchanged."""
    return score_rows(rows, probability, model_version, threshold)


def score_stream_with_model(
    model: PipelineModel, features: DataFrame, model_version: str, threshold: float = 0.5
) -> DataFrame:
    """Live feature rows through a stored model; the model's stages are row-wise too."""
    return score_rows(predict(model, features), F.col("score"), model_version, threshold)


def replay_safe(
    stream: DataFrame, out_dir: str, checkpoint_dir: str, keys: Sequence[str] = (), ts: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Process everything available into a table in which a batch that is run again changes nothing.

    A batch writes into the folder of its number and overwrites what an earlier attempt left there, so a failure between the
    write and the commit of the batch leaves no second copy. With ``keys`` rows that are sent again are dropped while the
    watermark ``delay`` behind ``ts`` has not passed them.
    """
    if keys:
        stream = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    query = (
        stream.writeStream.foreachBatch(write_batch(out_dir))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).option("basePath", out_dir).parquet(f"{out_dir}/batch=*")


def write_batch(out_dir: str) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch to the folder of its number, in place of what is there."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    return write


def drain(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """Process everything available into a Parquet table and return that table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out_dir)
