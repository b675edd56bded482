"""Temporal split of whole sessions by start time, and its leakage checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.operators.skew import join_lookup
from cartsight.params import DAY_US, SECOND_US, SplitParams

TRAIN, VAL, TEST = "train", "val", "test"


@dataclass(frozen=True)
class SplitEnds:
    """The three end instants, as microseconds since the epoch."""

    train_us: int
    val_us: int
    test_us: int

    @staticmethod
    def from_dates(train: str, val: str, test: str) -> "SplitEnds":
        return SplitEnds(*[_midnight_us(d) for d in (train, val, test)])


def _midnight_us(day: str) -> int:
    parsed = datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=timezone.utc)
    return int(parsed.timestamp()) * SECOND_US


def split_days(n_days: int, params: SplitParams = SplitParams()) -> tuple[int, int, int]:
    """Whole days per split. Truncates the float product: 90 days give 62, not 63, train days."""
    train, val = int(n_days * params.train_share), int(n_days * params.val_share)
    return train, val, n_days - train - val


def split_ends(start: str, n_days: int, params: SplitParams = SplitParams()) -> SplitEnds:
    """Ends are the midnights reached after each run of days."""
    train, val, test = split_days(n_days, params)
    first = datetime.strptime(start, "%Y-%m-%d")
    days = (train, train + val, train + val + test)
    return SplitEnds.from_dates(*[(first + timedelta(days=d)).strftime("%Y-%m-%d") for d in days])


def split_calendar(events: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """The split-date rule applied to the day span of an event table (one row)."""
    day = F.floor(F.col("us") / F.lit(DAY_US))
    span = events.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    n = F.col("n_days")
    return (
        span.withColumn("n_days", (F.col("last_day") - F.col("first_day") + 1).cast("long"))
        .withColumn("train_days", F.floor(n * F.lit(params.train_share)).cast("long"))
        .withColumn("val_days", F.floor(n * F.lit(params.val_share)).cast("long"))
        .withColumn("test_days", n - F.col("train_days") - F.col("val_days"))
        .withColumn("train_end_us", (F.col("first_day") + F.col("train_days")) * DAY_US)
        .withColumn("val_end_us", F.col("train_end_us") + F.col("val_days") * DAY_US)
        .withColumn("test_end_us", F.col("val_end_us") + F.col("test_days") * DAY_US)
        .drop("first_day", "last_day")
    )


def ends_of(events: DataFrame, params: SplitParams = SplitParams()) -> SplitEnds:
    row = split_calendar(events, params).first()
    return SplitEnds(row["train_end_us"], row["val_end_us"], row["test_end_us"])


def split_name(start_us: Column, ends: SplitEnds) -> Column:
    """Each end belongs to the earlier split; null after the last end."""
    return (
        F.when(start_us <= ends.train_us, TRAIN)
        .when(start_us <= ends.val_us, VAL)
        .when(start_us <= ends.test_us, TEST)
    )


def temporal_split(sessionized: DataFrame, ends: SplitEnds) -> DataFrame:
    """Add ``split``; sessions starting after the last end are left out.

    A narrow projection when the sessionizer's ``session_start_us`` is present.
    """
    if "session_start_us" not in sessionized.columns:
        sessionized = with_session_start(sessionized)
    named = sessionized.withColumn("split", split_name(F.col("session_start_us"), ends))
    return named.where(F.col("split").isNotNull())


def with_session_start(sessionized: DataFrame) -> DataFrame:
    """Session start for tables that carry only a session id.

    The starts are pre-aggregated to one row per session.
    """
    starts = sessionized.groupBy("session_id").agg(F.min("us").alias("session_start_us"))
    return join_lookup(sessionized, starts, "session_id", "inner", computed=True)


def events_of_sessions(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Keep the events whose session is in the given set."""
    return events.join(sessions.select("session_id").distinct(), "session_id", "left_semi")


def split_summary(split: DataFrame) -> DataFrame:
    """Events and sessions per split, counting distinct sessions in two combinable steps."""
    per_session = split.groupBy("split", "user_id", "session_seq").agg(F.count(F.lit(1)).alias("n"))
    return per_session.groupBy("split").agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_sessions")
    )


def split_violations(split: DataFrame, ends: SplitEnds) -> DataFrame:
    """One row of violation counts, all zero for a sound split."""
    start, name = F.col("session_start_us"), F.col("split")
    return split.agg(
        F.count_if((name == TRAIN) & (start > ends.train_us)).alias("late_train"),
        F.count_if((name == VAL) & (start <= ends.train_us)).alias("early_val"),
        F.count_if((name == TEST) & (start <= ends.val_us)).alias("early_test"),
        F.when(F.count_if(name == TRAIN) == 0, 1).otherwise(0).alias("empty_train"),
    )


def assert_no_leakage(split: DataFrame, ends: SplitEnds) -> None:
    """Raise when a session sits in a split its start does not belong to, or train is empty."""
    row = split_violations(split, ends).first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise AssertionError(f"Temporal leakage: {bad}")
