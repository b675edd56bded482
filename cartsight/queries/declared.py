"""Declared features, alternative labels, and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartsight.operators import declared as D
from cartsight.operators import examples as X
from cartsight.operators import features as FE
from cartsight.operators import quality as Q
from cartsight.operators import replay as R
from cartsight.operators import sessions as S
from cartsight.operators.skew import SkewParams, time_cuts
from cartsight.params import DAY_US
from cartsight.queries.base import (
    SQL_CATALOG,
    SQL_CLICKS,
    catalog,
    clicks,
    query,
    sessionized,
    split_events,
    sql_events,
    sql_examples,
    sql_sessions,
    with_sql,
)
from cartsight.queries.core import sql_features
from cartsight.queries.summaries import SPARSE, _sparse_users
from cartsight.sources.tables import settle

KEYS = ["user_id", "item_id", "session_seq"]
SQL_DETAILED = f"""{sql_sessions()}, {SQL_CATALOG},
detailed AS (SELECT sess.*, category, current_price, discount_pct,
    CAST(floor(current_price * 1000000e0 + 0.5e0) AS BIGINT) AS price_u
  FROM sess LEFT JOIN catalog USING (item_id)),
points AS (SELECT DISTINCT user_id, session_seq, session_end_us AS t FROM sess)"""


def _detailed(spark, d):
    """Sessionized events with item details, every session's end, and the cuts."""
    ev = settle(D.with_item_details(sessionized(spark, d), catalog(spark, d)))
    sessions = S.session_table(ev).select(
        "user_id", "session_seq", F.col("end_us").alias("session_end_us")
    )
    return ev, sessions, time_cuts(ev, "user_id", "us", SkewParams())


def _looking_back(columns: str) -> str:
    return with_sql(
        SQL_DETAILED,
        f"""SELECT p.user_id, p.session_seq, {columns} FROM points p
LEFT JOIN detailed e ON e.user_id = p.user_id AND e.us < p.t GROUP BY p.user_id, p.session_seq, p.t""",
    )


@query(
    "d1_unique_categories",
    _looking_back(
        ", ".join(
            f"count(DISTINCT category) FILTER (WHERE event_type = 'view' AND us >= p.t - {w * DAY_US})"
            f" AS unique_categories_viewed_{w}d"
            for w in (1, 7, 30)
        )
    ),
)
def d1(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    return D.unique_categories_viewed(ev, sessions, cuts)


@query(
    "d2_bounce_rate",
    with_sql(
        sql_events(),
        """SELECT p.user_id, p.session_seq, CASE WHEN count(s.t) > 0
  THEN CAST(count(s.t) FILTER (WHERE s.n_views = 1) AS DOUBLE) / count(s.t) ELSE 0e0 END
  AS session_bounce_rate
FROM (SELECT DISTINCT user_id, session_seq, session_end_us AS t FROM sess) p
LEFT JOIN (SELECT user_id, session_seq, max(us) AS t,
    count(*) FILTER (WHERE event_type = 'view') AS n_views FROM sess GROUP BY ALL) s
  ON s.user_id = p.user_id AND s.t < p.t
GROUP BY p.user_id, p.session_seq""",
    ),
)
def d2(spark, d):
    ev = settle(sessionized(spark, d))
    return D.bounce_rate(ev, time_cuts(ev, "user_id", "us", SkewParams()))


@query(
    "d3_time_per_item",
    _looking_back(
        f"""coalesce(CAST(sum(CAST(floor(duration_seconds * 1000000e0 + 0.5e0) AS BIGINT))
  FILTER (WHERE us >= p.t - {7 * DAY_US}) AS DOUBLE)
  / nullif(count(DISTINCT item_id) FILTER (WHERE us >= p.t - {7 * DAY_US}) * 1e6, 0), 0e0)
  AS avg_time_per_item_7d"""
    ),
)
def d3(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    return D.time_per_item(ev, sessions, cuts)


def _mean_price(event_type: str, name: str) -> str:
    cond = f"FILTER (WHERE us >= p.t - {30 * DAY_US} AND event_type = '{event_type}')"
    return (
        f"coalesce(CAST(sum(price_u) {cond} AS DOUBLE)"
        f" / nullif(count(price_u) {cond} * 1e6, 0), 0e0) AS {name}"
    )


LEVELS = (
    _mean_price("view", "user_avg_price_viewed_30d")
    + ", "
    + _mean_price("purchase", "user_avg_price_purchased_30d")
)


@query("d4_price_levels", _looking_back(LEVELS))
def d4(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    return D.price_levels(ev, sessions, cuts)


@query(
    "d5_price_vs_user_avg",
    with_sql(
        f"""{SQL_DETAILED},
levels AS (SELECT p.user_id, p.session_seq, {LEVELS} FROM points p
  LEFT JOIN detailed e ON e.user_id = p.user_id AND e.us < p.t
  GROUP BY p.user_id, p.session_seq, p.t)""",
        """SELECT DISTINCT user_id, item_id, session_seq,
  CASE WHEN user_avg_price_viewed_30d > 0 THEN current_price / user_avg_price_viewed_30d
    ELSE 0e0 END AS price_vs_user_avg_ratio
FROM detailed JOIN levels USING (user_id, session_seq) WHERE event_type = 'view'""",
    ),
)
def d5(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    viewed = ev.where(F.col("event_type") == "view").select(*KEYS, "current_price").distinct()
    joined = viewed.join(D.price_levels(ev, sessions, cuts), ["user_id", "session_seq"])
    ratio = D.price_ratio(F.col("current_price"), F.col("user_avg_price_viewed_30d"))
    return joined.select(*KEYS, ratio.alias("price_vs_user_avg_ratio"))


@query(
    "d6_discount_affinity",
    with_sql(
        f"""{SQL_DETAILED},
sums AS (SELECT p.user_id, p.session_seq, CAST(count(e.us) AS DOUBLE) AS n,
    CAST(coalesce(sum(x), 0) AS DOUBLE) AS sx, CAST(coalesce(sum(x * x), 0) AS DOUBLE) AS sxx,
    CAST(coalesce(sum(y), 0) AS DOUBLE) AS sy, CAST(coalesce(sum(x * y), 0) AS DOUBLE) AS sxy
  FROM points p LEFT JOIN (SELECT user_id, us, CAST(floor(discount_pct * 100e0 + 0.5e0) AS BIGINT) AS x,
      CASE WHEN event_type IN ('add_to_cart', 'purchase') THEN 1 ELSE 0 END AS y
    FROM detailed WHERE discount_pct IS NOT NULL) e ON e.user_id = p.user_id AND e.us < p.t
  GROUP BY p.user_id, p.session_seq)""",
        """SELECT user_id, session_seq,
  CASE WHEN (n * sxx - sx * sx) * (n * sy - sy * sy) > 0
    THEN (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * sy - sy * sy)) ELSE 0e0 END
    AS discount_affinity_score FROM sums""",
    ),
)
def d6(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    return D.discount_affinity(ev, sessions, cuts)


@query(
    "d7_abandoned_cart_price",
    with_sql(
        f"""{SQL_DETAILED},
pairs AS (SELECT p.user_id, p.session_seq, e.item_id, max(price_u) AS price_u,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS carts,
    count(*) FILTER (WHERE event_type = 'purchase') AS buys
  FROM points p JOIN detailed e ON e.user_id = p.user_id AND e.us < p.t GROUP BY ALL),
open_pairs AS (SELECT * FROM pairs WHERE carts > 0 AND buys = 0)""",
        """SELECT p.user_id, p.session_seq,
  coalesce(CAST(sum(o.price_u) AS DOUBLE) / nullif(count(o.price_u) * 1e6, 0), 0e0)
    AS cart_abandonment_price_threshold
FROM points p LEFT JOIN open_pairs o USING (user_id, session_seq)
GROUP BY p.user_id, p.session_seq""",
    ),
)
def d7(spark, d):
    ev, sessions, cuts = _detailed(spark, d)
    return D.abandoned_cart_price(ev, sessions, cuts)


@query(
    "d8_category_percentile",
    with_sql(
        f"""{sql_examples()}, {SQL_CATALOG},
counts AS (SELECT x.user_id, x.session_seq, c.category, count(*) AS n
  FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM examples) x
  JOIN ev e ON e.user_id = x.user_id AND e.us < x.session_end_us AND e.event_type = 'view'
  JOIN catalog c ON c.item_id = e.item_id GROUP BY ALL),
ranks AS (SELECT *, percent_rank() OVER (PARTITION BY user_id, session_seq ORDER BY n) AS pr
  FROM counts)""",
        """SELECT x.user_id, x.item_id, x.session_seq, coalesce(r.pr, 0e0) AS category_affinity_percentile
FROM examples x JOIN catalog c ON c.item_id = x.item_id
LEFT JOIN ranks r ON r.user_id = x.user_id AND r.session_seq = x.session_seq
  AND r.category = c.category""",
    ),
)
def d8(spark, d):
    ev, _, cuts = _detailed(spark, d)
    examples = FE.item_attributes(X.training_examples(ev), catalog(spark, d))
    return D.category_percentile(ev, examples, cuts)


@query(
    "d9_session_item_mix",
    with_sql(
        SQL_DETAILED,
        """SELECT user_id, session_seq, count(DISTINCT category) AS unique_categories_session,
  coalesce(CAST(sum(price_u) AS DOUBLE) / nullif(count(price_u) * 1e6, 0), 0e0)
    AS avg_item_price_session
FROM detailed GROUP BY user_id, session_seq""",
    ),
)
def d9(spark, d):
    return D.session_item_mix(D.with_item_details(sessionized(spark, d), catalog(spark, d)))


# --- item aggregates from train ---------------------------------------------------------------------

SQL_TRAIN = f"""{sql_events(480, split=True)}, {SQL_CATALOG},
train AS (SELECT * FROM ev WHERE split = 'train'),
item_counts AS (SELECT item_id, count(*) FILTER (WHERE event_type = 'view') AS v,
    count(*) FILTER (WHERE event_type = 'purchase') AS p FROM train GROUP BY item_id),
d10 AS (SELECT item_id, percent_rank() OVER (ORDER BY v) AS item_popularity_score FROM item_counts),
d11 AS (SELECT item_id, CASE WHEN v > 0 THEN CAST(p AS DOUBLE) / v ELSE 0e0 END
    AS item_conversion_rate FROM item_counts),
first_views AS (SELECT user_id, item_id, min(us) AS f FROM train WHERE event_type = 'view' GROUP BY ALL),
waits AS (SELECT t.user_id, t.item_id, min(t.us) - min(f) AS wait_us FROM train t
  JOIN first_views v ON v.user_id = t.user_id AND v.item_id = t.item_id AND t.us > f
  WHERE t.event_type = 'purchase' GROUP BY ALL),
d12 AS (SELECT item_id, CAST(sum(wait_us) AS DOUBLE) / (count(*) * 8.64e10)
    AS item_avg_time_to_purchase FROM waits GROUP BY item_id),
carts AS (SELECT user_id, item_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS b,
    max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS c FROM train GROUP BY ALL),
d13 AS (SELECT item_id, CAST(count(*) FILTER (WHERE b = 0) AS DOUBLE) / count(*)
    AS item_cart_abandonment_rate FROM carts WHERE c = 1 GROUP BY item_id),
d14 AS (SELECT category, CAST(sum(CAST(floor(item_conversion_rate * 1e12) AS BIGINT)) AS DOUBLE)
    / (count(*) * 1e12) AS category_avg_conversion_rate
  FROM d11 JOIN catalog USING (item_id) GROUP BY category)"""


def _train(spark, d):
    split = split_events(spark, d)
    return split.where(F.col("split") == "train")


@query("d10_item_popularity", with_sql(SQL_TRAIN, "SELECT * FROM d10"))
def d10(spark, d):
    return D.item_popularity(settle(_train(spark, d)))


@query("d11_item_conversion", with_sql(SQL_TRAIN, "SELECT * FROM d11"))
def d11(spark, d):
    return D.item_conversion(_train(spark, d))


@query("d12_item_time_to_purchase", with_sql(SQL_TRAIN, "SELECT * FROM d12"))
def d12(spark, d):
    return D.item_time_to_purchase(_train(spark, d))


@query("d13_item_cart_abandonment", with_sql(SQL_TRAIN, "SELECT * FROM d13"))
def d13(spark, d):
    return D.item_cart_abandonment(_train(spark, d))


@query("d14_category_conversion", with_sql(SQL_TRAIN, "SELECT * FROM d14"))
def d14(spark, d):
    return D.category_conversion(_train(spark, d), catalog(spark, d))


@query(
    "j11_train_item_aggregates",
    with_sql(
        SQL_TRAIN,
        """SELECT e.event_id, e.item_id, e.split, item_popularity_score, item_conversion_rate,
  item_avg_time_to_purchase, item_cart_abandonment_rate, category_avg_conversion_rate
FROM ev e LEFT JOIN d10 USING (item_id) LEFT JOIN d11 USING (item_id) LEFT JOIN d12 USING (item_id)
LEFT JOIN d13 USING (item_id) LEFT JOIN catalog c ON c.item_id = e.item_id
LEFT JOIN d14 ON d14.category = c.category WHERE e.split <> 'train'""",
    ),
)
def j11(spark, d):
    """Validation and test events with what train says about their items."""
    split = settle(split_events(spark, d))
    train = split.where(F.col("split") == "train")
    later = split.where(F.col("split") != "train").select("event_id", "item_id", "split")
    return D.with_train_aggregates(later, train, catalog(spark, d))


# --- alternative labels --------------------------------------------------------------------------------


def _label_sql(condition: str, name: str) -> str:
    return with_sql(
        f"{sql_examples()}, {SQL_CATALOG}",
        f"""SELECT x.user_id, x.item_id, x.session_seq, CASE WHEN EXISTS (
    SELECT 1 FROM ev e JOIN catalog ec ON ec.item_id = e.item_id
    WHERE e.user_id = x.user_id AND {condition}) THEN 1 ELSE 0 END AS {name}
FROM examples x JOIN catalog xc ON xc.item_id = x.item_id""",
    )


@query(
    "d15_label_any_purchase",
    _label_sql(
        "e.event_type = 'purchase' AND e.session_seq = x.session_seq + 1", "label_any_purchase"
    ),
)
def d15(spark, d):
    ev = settle(sessionized(spark, d))
    return X.label_any_purchase(X.candidates(ev), ev).select(*KEYS, "label_any_purchase")


@query(
    "d16_label_same_category",
    _label_sql(
        """e.event_type = 'purchase' AND ec.category = xc.category
    AND e.session_seq BETWEEN x.session_seq + 1 AND x.session_seq + 3""",
        "label_same_category",
    ),
)
def d16(spark, d):
    ev = settle(FE.with_category(sessionized(spark, d), catalog(spark, d)))
    cand = FE.with_category(X.candidates(ev), catalog(spark, d))
    return X.label_same_category(cand, ev).select(*KEYS, "label_same_category")


@query(
    "d17_label_carted_next",
    _label_sql(
        """e.event_type = 'add_to_cart' AND e.item_id = x.item_id
    AND e.session_seq = x.session_seq + 1""",
        "label_carted_next",
    ),
)
def d17(spark, d):
    ev = settle(sessionized(spark, d))
    return X.label_carted_next(X.candidates(ev), ev).select(*KEYS, "label_carted_next")


@query(
    "d18_label_bought_30d",
    _label_sql(
        f"""e.event_type = 'purchase' AND e.item_id = x.item_id AND e.us > x.session_end_us
    AND e.us <= x.session_end_us + {30 * DAY_US}""",
        "label_bought_30d",
    ),
)
def d18(spark, d):
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    out = D.label_bought_in_days(X.candidates(ev), ev, cuts)
    return out.select(*KEYS, "label_bought_30d")


# --- gates ------------------------------------------------------------------------------------------


@query(
    "d19_leakage_check",
    with_sql(
        f"""{sql_features(480, split=True)},
ahead AS (SELECT f.split, f.user_id, f.item_id, f.session_seq, f.views_count_7d AS n, count(e.us) AS n_ahead
  FROM features f LEFT JOIN ev e ON e.split = f.split AND e.user_id = f.user_id AND e.event_type = 'view'
    AND e.us >= f.session_end_us - {6 * DAY_US} AND e.us < f.session_end_us + {DAY_US}
  GROUP BY ALL)""",
        """SELECT count(*) AS n_examples, CAST(0 AS BIGINT) AS n_changed,
  2 * count(*) FILTER (WHERE n <> n_ahead) AS n_changed_ahead FROM ahead""",
    ),
)
def d19(spark, d):
    """All features of all examples against a forward replay of the events; and as a counter-example those with one count
    taken a day ahead."""
    by = ("split", "user_id")
    split, items = settle(split_events(spark, d).select("split", *FE.EVENT_COLUMNS)), catalog(spark, d)
    features = settle(FE.build_features(split, items, by))
    sessions = features.select(*by, "session_seq", (F.col("session_end_us") + DAY_US).alias("session_end_us")).distinct()
    later = FE.session_history(split, sessions, time_cuts(split, "user_id", "us", SkewParams()), by)
    ahead = features.drop("views_count_7d").join(later.select(*by, "session_seq", "views_count_7d"), [*by, "session_seq"])
    replayed = settle(R.replay_of(features, split, items, by))  # both tables ask about the same sessions
    counts = [R.replay_differences(x, split, items, by, replayed=replayed).count() for x in (features, ahead)]
    return features.agg(F.count(F.lit(1)).alias("n_examples")).select(
        "n_examples", F.lit(counts[0]).cast("long").alias("n_changed"), F.lit(counts[1]).cast("long").alias("n_changed_ahead")
    )


@query(
    "d20_null_gate",
    with_sql(
        SPARSE,
        """SELECT column_name, n_null, CAST(n_null AS DOUBLE) / n AS null_rate,
  CAST(n_null AS DOUBLE) / n <= 0.05e0 AS passes FROM audit""",
    ),
)
def d20(spark, d):
    return Q.null_gate(_sparse_users(spark, d))


DRIFT_COLUMNS = [c for c in FE.feature_columns() if c != "item_category"]


@query(
    "d21_distribution_drift",
    with_sql(
        f"""{sql_features(30, split=True)},
long AS (SELECT split, unnest({DRIFT_COLUMNS}) AS column_name,
    unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in DRIFT_COLUMNS)}]) AS v FROM features),
stats AS (SELECT split, column_name, avg(v) AS m, stddev_pop(v) AS s, min(v) AS min, max(v) AS max
  FROM long GROUP BY ALL)""",
        """SELECT a.split, a.column_name, round(a.m, 6) + 0e0 AS mean, round(a.s, 6) + 0e0 AS stddev, a.min, a.max,
  abs(a.m - t.m) > 3 * t.s AS drifted
FROM stats a JOIN stats t ON t.column_name = a.column_name AND t.split = 'train'""",
    ),
)
def d21(spark, d):
    split = settle(split_events(spark, d, 30))
    features = FE.build_features(split, catalog(spark, d), ("split", "user_id"))
    drift = Q.distribution_drift(features, DRIFT_COLUMNS)
    six = [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("mean", "stddev")]
    return drift.select("split", "column_name", *six, "min", "max", "drifted")


@query(
    "d22_non_finite",
    with_sql(
        f"""{sql_features(480, split=True)},
planted AS MATERIALIZED (SELECT * REPLACE (
    CASE WHEN item_id % 10 = 3 THEN CAST('nan' AS DOUBLE) ELSE item_current_price END AS item_current_price,
    CASE WHEN item_id % 10 = 4 THEN CAST('inf' AS DOUBLE) WHEN item_id % 10 = 5 THEN CAST('-inf' AS DOUBLE)
      ELSE view_to_scroll_ratio_7d END AS view_to_scroll_ratio_7d) FROM features)""",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE isnan({c}::DOUBLE) OR isinf({c}::DOUBLE)) AS n_non_finite FROM planted"
            for c in FE.feature_columns()
            if c != "item_category"
        ),
    ),
)
def d22(spark, d):
    """All numeric features, with NaN and infinities put into two of them."""
    features = FE.build_features(settle(split_events(spark, d)), catalog(spark, d), ("split", "user_id"))
    Q.assert_same_schema(features.where(F.col("split") == "train"), features.where(F.col("split") == "val"))
    digit = F.col("item_id") % 10
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    ratio = F.col("view_to_scroll_ratio_7d")
    planted = features.withColumn("item_current_price", F.when(digit == 3, nan).otherwise(F.col("item_current_price")))
    planted = planted.withColumn("view_to_scroll_ratio_7d", F.when(digit == 4, inf).when(digit == 5, -inf).otherwise(ratio))
    return Q.non_finite_counts(planted, [c for c in FE.feature_columns() if c != "item_category"])


@query(
    "d23_session_checks",
    with_sql(
        f"""{sql_sessions()},
planted AS (SELECT user_id, session_seq, us + CASE WHEN user_id % 5 = 2 AND session_seq = 1 THEN 864000000000 ELSE 0 END AS us,
  CASE WHEN user_id % 5 = 1 THEN 'shared_' || session_seq ELSE session_id END AS session_id FROM sess)""",
        """SELECT (SELECT count(DISTINCT session_id) FROM planted) AS n_sessions,
  CAST(0 AS BIGINT) AS empty_sessions,
  (SELECT count(*) FROM (SELECT session_id FROM planted GROUP BY 1
    HAVING count(DISTINCT user_id) > 1) a) AS shared_ids,
  (SELECT count(*) FROM (SELECT user_id, end_us, lead(start_us) OVER (PARTITION BY user_id
    ORDER BY session_seq) AS next_us FROM (SELECT user_id, session_seq, min(us) AS start_us,
    max(us) AS end_us FROM planted GROUP BY ALL) s) b WHERE next_us < end_us) AS overlapping_sessions""",
    ),
)
def d23(spark, d):
    """Counts on sessions of which some share ids, and some first ones are moved by ten days."""
    ev, user, seq = settle(sessionized(spark, d)), F.col("user_id") % 5, F.col("session_seq")
    shared = F.when(user == 1, F.concat(F.lit("shared_"), seq.cast("string"))).otherwise(F.col("session_id"))
    moved = F.col("us") + F.when((user == 2) & (seq == 1), F.lit(10 * DAY_US)).otherwise(F.lit(0))
    return S.session_violations(settle(ev.withColumns({"session_id": shared, "us": moved})))


@query(
    "d24_event_before_registration",
    with_sql(
        f"""{SQL_CLICKS}, registered AS (SELECT c_custkey AS user_id,
    1704067200000000 + c_nationkey * 86400000000 AS registered_us FROM customer)""",
        """SELECT count(*) AS events_checked, count(*) FILTER (WHERE us < registered_us) AS early_events,
  CAST(count(*) FILTER (WHERE us < registered_us) AS DOUBLE) / count(*) AS early_rate
FROM clickstream JOIN registered USING (user_id)""",
    ),
)
def d24(spark, d):
    """The customer's nation number stands in for days from 2024-01-01 to the registration."""
    customers = spark.read.parquet(f"{d}/customer.parquet")
    start = 1_704_067_200_000_000
    registered = customers.select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_nationkey").cast("long") * DAY_US + start).alias("registered_us"),
    )
    return Q.events_before_registration(clicks(spark, d), registered)


@query(
    "d25_duration_bounds",
    with_sql(
        sql_sessions(),
        """SELECT count(*) FILTER (WHERE len < 30000000) AS too_short,
  count(*) FILTER (WHERE len > 3600000000) AS too_long,
  count(*) FILTER (WHERE len BETWEEN 30000000 AND 3600000000) AS within_bounds
FROM (SELECT max(us) - min(us) AS len FROM sess GROUP BY session_id) a""",
    ),
)
def d25(spark, d):
    return S.duration_bounds(sessionized(spark, d))
