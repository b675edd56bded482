"""Training examples: (user, session, viewed item) with look-ahead labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.operators.sessions import lookahead_span
from cartsight.params import ADD_TO_CART, PURCHASE, VIEW, FeatureParams

USER = ("user_id",)


def viewed_items(ev: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """Distinct items viewed per session."""
    views = ev.where(F.col("event_type") == VIEW)
    return views.select(*by, "session_seq", "session_id", "item_id").distinct()


def _back_shifted(keys: DataFrame, horizon: int) -> DataFrame:
    """Rows keyed by session s, re-keyed to each of the sessions s-1 .. s-horizon before it."""
    offsets = F.array(*[F.lit(i) for i in range(1, horizon + 1)])
    return (
        keys.withColumn("_off", F.explode(offsets))
        .withColumn("session_seq", F.col("session_seq") - F.col("_off"))
        .drop("_off")
        .where(F.col("session_seq") > 0)
        .distinct()
    )


def acted_within(
    ev: DataFrame,
    event_type: str,
    horizon: int,
    by: Sequence[str] = USER,
    on: Sequence[str] = ("item_id",),
) -> DataFrame:
    """Distinct (user, key, session) such that the act follows within ``horizon`` sessions.

    The band condition on the session number becomes an equi key: every acting session is
    re-keyed to the sessions it answers for, so the later join is on a unique key.
    """
    acts = ev.where(F.col("event_type") == event_type).select(*by, *on, "session_seq").distinct()
    return _back_shifted(acts, horizon)


def flag_examples(
    cand: DataFrame, hits: DataFrame, keys: Sequence[str], name: str = "label"
) -> DataFrame:
    marked = hits.select(*keys).withColumn(name, F.lit(1))
    return cand.join(marked, list(keys), "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0))
    )


def candidates(
    ev: DataFrame, by: Sequence[str] = USER, horizon: int = 3, eligible: DataFrame | None = None
) -> DataFrame:
    """Viewed items of every session that has a full look-ahead, with the session's end.

    ``eligible`` may give those sessions, with further columns (``by``, session_seq,
    session_end_us, ...) that are carried along.
    """
    if eligible is None:
        ends = F.max("us").alias("session_end_us")
        eligible = lookahead_span(ev.groupBy(*by, "session_seq").agg(ends), horizon, by)
    return viewed_items(ev, by).join(eligible, [*by, "session_seq"])


def training_examples(
    ev: DataFrame,
    by: Sequence[str] = USER,
    params: FeatureParams = FeatureParams(),
    eligible: DataFrame | None = None,
) -> DataFrame:
    """Candidates labelled 1 when the item is bought in any of the next sessions."""
    horizon = params.horizon_sessions
    bought = acted_within(ev, PURCHASE, horizon, by)
    cand = candidates(ev, by, horizon, eligible)
    return flag_examples(cand, bought, [*by, "item_id", "session_seq"])


# --- alternative labels -------------------------------------------------------------------------


def label_any_purchase(cand: DataFrame, ev: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """Anything bought in the next session."""
    hits = acted_within(ev, PURCHASE, 1, by, on=())
    return flag_examples(cand, hits, [*by, "session_seq"], "label_any_purchase")


def label_same_category(
    cand: DataFrame, ev: DataFrame, by: Sequence[str] = USER, horizon: int = 3
) -> DataFrame:
    """An item of the same category bought within the horizon. Both inputs carry ``category``."""
    hits = acted_within(ev, PURCHASE, horizon, by, on=("category",))
    keys = [*by, "category", "session_seq"]
    return flag_examples(cand, hits, keys, "label_same_category")


def label_carted_next(cand: DataFrame, ev: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """The item put in the cart in the next session."""
    hits = acted_within(ev, ADD_TO_CART, 1, by)
    return flag_examples(cand, hits, [*by, "item_id", "session_seq"], "label_carted_next")
