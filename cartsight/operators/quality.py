"""Quality gates over feature tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import guarded_ratio
from cartsight.operators.skew import join_lookup
from cartsight.operators.summaries import null_audit


def null_gate(df: DataFrame, max_rate: float = 0.05) -> DataFrame:
    """Every column with its null rate and whether it passes the gate."""
    audit = null_audit(df, all_columns=True)
    return audit.withColumn("passes", F.col("null_rate") <= F.lit(max_rate))


def assert_null_gate(df: DataFrame, max_rate: float = 0.05) -> None:
    failed = [r["column_name"] for r in null_gate(df, max_rate).where(~F.col("passes")).collect()]
    if failed:
        raise AssertionError(f"Columns above the null limit: {failed}")


def leakage_differences(
    ev: DataFrame, build: Callable[[DataFrame], DataFrame], ends: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of a feature table that change when events at or after the row's end are removed.

    ``ends`` has one row per ``keys`` (user and the session to test) with ``session_end_us``: one
    session per user, so that one truncated event table answers for all users at once. Must be
    empty: point-in-time features may not depend on what follows.
    """
    tested = ends.select(*keys, "session_end_us")
    cutoff = tested.select("user_id", F.col("session_end_us").alias("_cut"))
    limited = join_lookup(ev, cutoff, "user_id", "inner")
    truncated = limited.where(F.col("us") < F.col("_cut")).drop("_cut")
    full = build(ev).join(tested.select(*keys), list(keys), "left_semi")
    cut = build(truncated).join(tested.select(*keys), list(keys), "left_semi")
    return full.exceptAll(cut).unionByName(cut.exceptAll(full))


def distribution_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population standard deviation, minimum and maximum per numeric column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.avg(x).alias(f"m_{i}"),
            F.stddev_pop(x).alias(f"s_{i}"),
            F.min(x).alias(f"a_{i}"),
            F.max(x).alias(f"b_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m_{i}").alias("mean"),
            F.col(f"s_{i}").alias("stddev"),
            F.col(f"a_{i}").alias("min"),
            F.col(f"b_{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def distribution_drift(features: DataFrame, columns: Sequence[str], sigmas: float = 3.0) -> DataFrame:
    """Split means compared with train: drifted when more than ``sigmas`` train deviations away."""
    stats = distribution_stats(features, columns, by=["split"])
    train = stats.where(F.col("split") == "train").select(
        "column_name", F.col("mean").alias("train_mean"), F.col("stddev").alias("train_stddev")
    )
    distance = F.abs(F.col("mean") - F.col("train_mean"))
    return stats.join(train, "column_name").select(
        "split",
        "column_name",
        "mean",
        "stddev",
        "min",
        "max",
        (distance > F.lit(sigmas) * F.col("train_stddev")).alias("drifted"),
    )


def non_finite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and infinite values per numeric column."""
    inf = F.lit(float("inf"))

    def bad(c: str):
        x = F.col(c).cast("double")
        return F.count_if(F.isnan(x) | (F.abs(x) == inf))

    wide = df.agg(*[bad(c).alias(f"n_{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("n_non_finite"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def assert_same_schema(a: DataFrame, b: DataFrame) -> None:
    """Splits must have the same columns with the same types."""
    left = [(f.name, f.dataType) for f in a.schema]
    right = [(f.name, f.dataType) for f in b.schema]
    if left != right:
        raise AssertionError(f"Schemas differ: {sorted(set(map(str, left)) ^ set(map(str, right)))}")


def events_before_registration(events: DataFrame, registered: DataFrame) -> DataFrame:
    """Events of registered users, and those earlier than the registration (one row).

    ``registered`` has one row per user: user_id, registered_us.
    """
    both = join_lookup(
        events.select("user_id", "us"), registered.select("user_id", "registered_us"), "user_id", "inner"
    )
    early = F.count_if(F.col("us") < F.col("registered_us"))
    return both.agg(
        F.count(F.lit(1)).alias("events_checked"),
        early.alias("early_events"),
        guarded_ratio(early, F.count(F.lit(1))).alias("early_rate"),
    )
