"""Dataset summaries and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import guarded_ratio, one_if
from cartsight.operators.ranking import exact_percentiles
from cartsight.params import PURCHASE, VIEW
from cartsight.sources.tables import settle


def counts_with_share(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value, most frequent first.

    The total is one number, taken over the stored rows, one per value.
    """
    counts = settle(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = guarded_ratio(F.col("n") * 100, F.lit(total).cast("long"))
    return counts.withColumn("percent", share).orderBy(F.col("n").desc(), column)


def clickstream_metrics(events: DataFrame) -> DataFrame:
    """Sessions, events per session, purchase rate of events, conversion of sessions (one row)."""
    per_session = events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(one_if(F.col("event_type") == PURCHASE)).alias("p")
    )
    n = F.count(F.lit(1))
    return per_session.agg(
        n.alias("n_sessions"),
        guarded_ratio(F.sum("n"), n).alias("events_per_session"),
        guarded_ratio(F.sum("p"), F.sum("n")).alias("purchase_rate"),
        guarded_ratio(F.count_if(F.col("p") > 0), n).alias("session_conversion"),
    )


def catalog_stats(catalog: DataFrame) -> DataFrame:
    """Size, categories, price statistics and discount rate of the catalog (one row).

    The median comes from global row numbers, so no task holds all prices.
    """
    price = F.col("current_price")
    cents = F.sum(F.floor(price * 1_000_000).cast("decimal(28,0)")).cast("double")
    n = F.count(F.lit(1))
    stats = catalog.agg(
        n.alias("n_items"),
        F.count_distinct("category").alias("n_categories"),
        F.try_divide(cents, n.cast("double") * F.lit(1_000_000.0)).alias("mean_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.count_if(F.col("discount_pct") > 0).alias("n_discounted"),
        guarded_ratio(F.count_if(F.col("discount_pct") > 0), n).alias("discount_rate"),
    ).withColumn("_k", F.lit(1))
    median = exact_percentiles(catalog, "current_price", [50.0]).select(
        F.col("value").alias("median_price"), F.lit(1).alias("_k")
    )
    return stats.join(median, "_k", "left").drop("_k")  # two one-row tables


def group_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def feature_set_summary(features: DataFrame, n_features: int) -> DataFrame:
    """Examples, features, positive rate, distinct users and items (one row).

    The two distinct counts are aggregated apart, so rows are not multiplied per distinct column.
    """
    n = F.count(F.lit(1))
    base = features.agg(
        n.alias("n_examples"),
        F.lit(n_features).alias("n_features"),
        guarded_ratio(F.sum("label"), n).alias("positive_rate"),
    ).withColumn("_k", F.lit(1))
    for column, name in (("user_id", "n_users"), ("item_id", "n_items")):
        distinct = features.select(column).distinct().agg(F.count(column).alias(name))
        base = base.join(distinct.withColumn("_k", F.lit(1)), "_k")  # one-row tables
    return base.drop("_k")


def label_balance(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n = F.count(F.lit(1))
    return features.groupBy(*by).agg(
        n.alias("n_examples"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
        guarded_ratio(F.sum("label"), n).alias("positive_rate"),
    )


def null_audit(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """Null count and rate per column, in one pass; only columns with nulls unless asked."""
    n = F.count(F.lit(1))
    wide = df.agg(
        n.alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{i}").alias("n_null"),
            guarded_ratio(F.col(f"n_{i}"), F.col("_n")).alias("null_rate"),
        )
        for i, c in enumerate(df.columns)
    ]
    audit = wide.select(F.inline(F.array(*rows)))
    return audit if all_columns else audit.where(F.col("n_null") > 0)


def first_users(events: DataFrame, n_users: int) -> DataFrame:
    """All events of the first ``n_users`` users in the order of first appearance."""
    firsts = events.groupBy("user_id").agg(F.min(F.struct("us", "event_id")).alias("f"))
    chosen = firsts.orderBy("f").limit(n_users).select("user_id")
    return events.join(chosen, "user_id", "left_semi")


def viewed_and_bought(sessionized: DataFrame) -> DataFrame:
    """Distinct (session, item) pairs viewed, and pairs purchased."""
    acts = sessionized.where(F.col("event_type").isin(VIEW, PURCHASE))
    return acts.select("session_id", "event_type", "item_id").distinct()
