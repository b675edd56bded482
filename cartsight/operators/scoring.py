"""Batch scoring: row validation, defaults, probabilities to decisions and confidence bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import confidence_band, decide

# The scoring row and its defaults. None: optional, stays null when absent.
RECENCY_COLUMNS = ("days_since_last_view", "days_since_last_item_view", "days_since_last_cart")
COUNT_COLUMNS = (
    "view_count_7d",
    "view_count_30d",
    "cart_count_7d",
    "cart_count_30d",
    "purchase_count_7d",
    "purchase_count_30d",
    "item_view_count",
    "item_cart_count",
)
RATIO_COLUMNS = ("cart_to_purchase_ratio",)
DURATION_COLUMNS = ("avg_session_duration", "session_duration_minutes")
PRICE_COLUMNS = ("item_price", "item_base_price")
REQUIRED_COLUMNS = ("user_id", "item_id", "item_price", "item_base_price", "item_category")
MAX_BATCH = 1000


def with_defaults(requests: DataFrame) -> DataFrame:
    """Absent columns and nulls become the declared defaults; recency stays null."""
    types = {c: "double" for c in RECENCY_COLUMNS + RATIO_COLUMNS + DURATION_COLUMNS}
    types |= {c: "long" for c in COUNT_COLUMNS} | {"session_item_count": "long"}
    types |= {"item_discount_pct": "double"}
    absent = {c: F.lit(None).cast(t) for c, t in types.items() if c not in requests.columns}
    filled = requests.withColumns(absent) if absent else requests
    zeros = {c: 0 for c in COUNT_COLUMNS}
    zeros |= {c: 0.0 for c in RATIO_COLUMNS + DURATION_COLUMNS + ("item_discount_pct",)}
    return filled.na.fill(zeros | {"session_item_count": 1})


def validation_rules() -> dict[str, Column]:
    """Name of each rule to the condition a valid row meets. Null optional values pass."""
    rules: dict[str, Column] = {}
    for c in REQUIRED_COLUMNS:
        rules[f"{c} is required"] = F.col(c).isNotNull()
    for c in RECENCY_COLUMNS + COUNT_COLUMNS + DURATION_COLUMNS:
        rules[f"{c} must be >= 0"] = F.col(c) >= 0
    for c in RATIO_COLUMNS:
        rules[f"{c} must be in [0, 1]"] = F.col(c).between(0, 1)
    for c in PRICE_COLUMNS:
        rules[f"{c} must be > 0"] = F.col(c) > 0
    rules["item_discount_pct must be in [0, 100]"] = F.col("item_discount_pct").between(0, 100)
    rules["session_item_count must be >= 1"] = F.col("session_item_count") >= 1
    return rules


def validate(requests: DataFrame) -> DataFrame:
    """Add ``valid`` and ``reject_reason`` (every broken rule, in order; null when valid)."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in validation_rules().items()
    ]
    reasons = F.concat_ws("; ", *broken)
    return requests.withColumn("valid", reasons == "").withColumn(
        "reject_reason", F.when(reasons != "", reasons)
    )


def check_batch_size(n: int) -> None:
    if not 1 <= n <= MAX_BATCH:
        raise ValueError(f"A batch has 1 to {MAX_BATCH} rows, got {n}")


def check_threshold(threshold: float) -> None:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError(f"Threshold must be in [0, 1], got {threshold}")


def align(df: DataFrame, wanted: Mapping[str, Column | None], keep: Sequence[str]) -> DataFrame:
    """Columns in the model's order; those that are missing become 0.

    ``wanted`` maps a model column to an expression, or to None for the column of that name.
    """
    out = []
    for name, expr in wanted.items():
        if expr is None:
            expr = F.col(name) if name in df.columns else F.lit(0)
        out.append(F.coalesce(expr.cast("double"), F.lit(0.0)).alias(name))
    return df.select(*keep, *out)


def category_dummies(categories: Sequence[str], column: str = "item_category") -> dict[str, Column]:
    """One 0/1 column per known category; an unknown category is 0 everywhere."""
    return {f"category_{c}": (F.col(column) == c).cast("int") for c in categories}


def score_rows(
    df: DataFrame, probability: Column, model_version: str, threshold: float = 0.5
) -> DataFrame:
    """user, item, prediction, probability, confidence and model version."""
    check_threshold(threshold)
    return df.select("user_id", "item_id", probability.alias("probability")).select(
        "user_id",
        "item_id",
        decide(F.col("probability"), threshold).alias("prediction"),
        "probability",
        confidence_band(F.col("probability")).alias("confidence"),
        F.lit(model_version).alias("model_version"),
    )


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = (0.3, 0.5, 0.7)) -> DataFrame:
    """Rows, and rows predicted positive, at each threshold: one pass, one column per threshold."""
    for t in thresholds:
        check_threshold(t)
    wide = scored.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("score") >= F.lit(t)).alias(f"t_{i}") for i, t in enumerate(thresholds)],
    )
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.col("n").alias("n_rows"),
            F.col(f"t_{i}").alias("n_positive"),
        )
        for i, t in enumerate(thresholds)
    ]
    return wide.select(F.inline(F.array(*rows)))
