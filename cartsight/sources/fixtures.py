"""Views of the given tables in the shape of the clickstream model.

The event log plays the clickstream, ``part`` the item catalog and ``customer`` the users.
Every view reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.functions.columns import discounted_price
from cartsight.sources.tables import read_table, with_micros

# How the given event types stand in for clickstream types.
EVENT_TYPE_MAP = {
    "view": "view",
    "click": "scroll",
    "signup": "add_to_cart",
    "error": "remove_from_cart",
    "purchase": "purchase",
}


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_of(_load(spark, sf_dir, "events"))


def clicks_of(events: DataFrame) -> DataFrame:
    """The clickstream of event rows, stored or live."""
    raw = with_micros(events, "ts")
    mapping = F.create_map(*[F.lit(x) for pair in EVENT_TYPE_MAP.items() for x in pair])
    return raw.select(
        "event_id",
        "user_id",
        "us",
        F.timestamp_micros("us").alias("timestamp"),
        F.try_element_at(mapping, F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        F.col("value").alias("duration_seconds"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        ((F.col("p_size") % 5) * 10).cast("double").alias("discount_pct"),
    )
    price = discounted_price(F.col("base_price"), F.col("discount_pct"))
    return part.withColumn("current_price", price)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("persona")
    )
