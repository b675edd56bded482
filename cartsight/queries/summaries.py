"""Aggregations and dataset summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartsight.operators import sessions as S
from cartsight.operators import summaries as A
from cartsight.operators.examples import training_examples, viewed_items
from cartsight.operators.ranking import exact_percentiles, score_histogram
from cartsight.operators.split import split_summary
from cartsight.queries.base import (
    SQL_CATALOG,
    SQL_CLICKS,
    catalog,
    clicks,
    query,
    scored_examples,
    sessionized,
    split_events,
    sql_events,
    sql_examples,
    sql_scored,
    sql_sessions,
    users,
    with_sql,
)
from cartsight.sources.tables import settle, table_counts

STATS_SELECT = """SELECT CAST(sum(n) AS BIGINT) AS total_events, count(*) AS total_sessions,
  CAST(sum(n) AS DOUBLE) / count(*) AS avg_events_per_session,
  CAST(sum(len_us) AS DOUBLE) / CAST(count(*) * 60000000 AS DOUBLE) AS avg_session_duration_minutes,
  CAST(sum(p) AS BIGINT) AS sessions_with_purchase,
  CAST(sum(p) AS DOUBLE) / count(*) AS conversion_rate
FROM (SELECT session_id, count(*) AS n, max(us) - min(us) AS len_us,
        max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p
      FROM sess GROUP BY session_id) a"""


@query(
    "a1_session_info",
    with_sql(
        sql_sessions(30),
        """SELECT session_id, min(us) AS start_us, max(us) AS end_us, min(user_id) AS user_id
FROM sess GROUP BY session_id""",
    ),
)
def a1(spark, d):
    return S.session_info(sessionized(spark, d, 30))


@query("a2_session_stats", with_sql(sql_sessions(30), STATS_SELECT))
def a2(spark, d):
    return S.session_stats(sessionized(spark, d, 30))


@query("a2_session_stats_480", with_sql(sql_sessions(480), STATS_SELECT))
def a2_480(spark, d):
    return S.session_stats(sessionized(spark, d, 480))


@query(
    "a3_any_purchase",
    with_sql(
        sql_sessions(30),
        """SELECT session_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase
FROM sess GROUP BY session_id""",
    ),
)
def a3(spark, d):
    return S.session_table(sessionized(spark, d, 30)).select("session_id", "has_purchase")


@query(
    "a4_session_start",
    with_sql(sql_sessions(30), "SELECT session_id, min(us) AS start_us FROM sess GROUP BY session_id"),
)
def a4(spark, d):
    return S.session_table(sessionized(spark, d, 30)).select("session_id", "start_us")


@query(
    "a5_session_size",
    with_sql(sql_sessions(30), "SELECT session_id, count(*) AS n FROM sess GROUP BY session_id"),
)
def a5(spark, d):
    return A.group_counts(sessionized(spark, d, 30), "session_id")


@query(
    "a6_conditional_count",
    with_sql(
        sql_sessions(),
        """SELECT session_id, count(*) FILTER (WHERE event_type = 'view') AS n_views,
  count(*) FILTER (WHERE event_type = 'scroll') AS n_scrolls,
  count(*) FILTER (WHERE event_type = 'add_to_cart') AS n_carts FROM sess GROUP BY session_id""",
    ),
)
def a6(spark, d):
    table = S.session_table(sessionized(spark, d))
    return table.select("session_id", "n_views", "n_scrolls", "n_carts")


@query(
    "a7_exact_distinct",
    with_sql(
        sql_sessions(),
        "SELECT user_id, count(DISTINCT item_id) AS n_items FROM sess GROUP BY user_id",
    ),
)
def a7(spark, d):
    return clicks(spark, d).groupBy("user_id").agg(F.count_distinct("item_id").alias("n_items"))


@query(
    "a8_distinct_items",
    with_sql(
        sql_sessions(),
        "SELECT DISTINCT user_id, session_seq, session_id, item_id FROM sess WHERE event_type = 'view'",
    ),
)
def a8(spark, d):
    return viewed_items(sessionized(spark, d))


@query(
    "a8_viewed_and_bought",
    with_sql(
        sql_sessions(),
        """SELECT DISTINCT session_id, event_type, item_id FROM sess
WHERE event_type IN ('view', 'purchase')""",
    ),
)
def a8b(spark, d):
    return A.viewed_and_bought(sessionized(spark, d))


@query(
    "a9_mean_of_boolean",
    with_sql(
        SQL_CLICKS,
        """SELECT item_id, CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) / count(*)
  AS purchase_rate FROM clickstream GROUP BY item_id""",
    ),
)
def a9(spark, d):
    rate = F.avg((F.col("event_type") == "purchase").cast("int"))
    return clicks(spark, d).groupBy("item_id").agg(rate.alias("purchase_rate"))


@query(
    "a10_event_breakdown",
    with_sql(
        SQL_CLICKS,
        """SELECT event_type, count(*) AS n,
  CAST(count(*) * 100 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percent
FROM clickstream GROUP BY event_type ORDER BY n DESC, event_type""",
    ),
)
def a10(spark, d):
    return A.counts_with_share(clicks(spark, d), "event_type")


@query(
    "a11_click_metrics",
    with_sql(
        sql_sessions(30),
        """SELECT count(*) AS n_sessions, CAST(sum(n) AS DOUBLE) / count(*) AS events_per_session,
  CAST(sum(p) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS purchase_rate,
  CAST(count(*) FILTER (WHERE p > 0) AS DOUBLE) / count(*) AS session_conversion
FROM (SELECT session_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS p
      FROM sess GROUP BY session_id) a""",
    ),
)
def a11(spark, d):
    return A.clickstream_metrics(sessionized(spark, d, 30))


@query(
    "a12_catalog_stats",
    with_sql(
        f"""{SQL_CATALOG},
ordered AS (SELECT current_price AS v, row_number() OVER (ORDER BY current_price) AS r,
    count(*) OVER () AS n FROM catalog),
median AS (SELECT lo + (hi - lo) * frac AS median_price FROM (
    SELECT max(v) FILTER (WHERE r = (n - 1) // 2 + 1) AS lo,
      max(v) FILTER (WHERE r = least((n - 1) // 2 + 2, n)) AS hi,
      max((n - 1) * 0.5e0 - (n - 1) // 2) AS frac FROM ordered) m)""",
        """SELECT count(*) AS n_items, count(DISTINCT category) AS n_categories,
  CAST(sum(CAST(floor(current_price * 1000000) AS BIGINT)) AS DOUBLE) / (count(*) * 1e6) AS mean_price,
  min(current_price) AS min_price, max(current_price) AS max_price,
  count(*) FILTER (WHERE discount_pct > 0) AS n_discounted,
  CAST(count(*) FILTER (WHERE discount_pct > 0) AS DOUBLE) / count(*) AS discount_rate,
  (SELECT median_price FROM median) AS median_price
FROM catalog""",
    ),
)
def a12(spark, d):
    return A.catalog_stats(catalog(spark, d))


@query(
    "a12_items_per_category",
    with_sql(SQL_CATALOG, "SELECT category, count(*) AS n FROM catalog GROUP BY category"),
)
def a12b(spark, d):
    return A.group_counts(catalog(spark, d), "category")


@query(
    "a13_persona_mix",
    """SELECT c_mktsegment AS persona, count(*) AS n,
  CAST(count(*) * 100 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percent
FROM customer GROUP BY c_mktsegment""",
)
def a13(spark, d):
    return A.counts_with_share(users(spark, d), "persona")


@query(
    "a14_split_summary",
    with_sql(
        sql_events(30, split=True),
        """SELECT split, count(*) AS n_events, count(DISTINCT session_id) AS n_sessions
FROM ev GROUP BY split""",
    ),
)
def a14(spark, d):
    return split_summary(split_events(spark, d, 30))


@query(
    "a15_feature_summary",
    with_sql(
        sql_examples(),
        """SELECT count(*) AS n_examples, 37 AS n_features,
  CAST(sum(label) AS DOUBLE) / count(*) AS positive_rate, count(DISTINCT user_id) AS n_users,
  count(DISTINCT item_id) AS n_items FROM examples""",
    ),
)
def a15(spark, d):
    return A.feature_set_summary(training_examples(settle(sessionized(spark, d))), 37)


def _sparse_users(spark, d):
    """Per user, first instants of event kinds: some users lack some kinds in some items."""
    kind = F.col("event_type")
    return clicks(spark, d).groupBy("user_id", "item_id").agg(
        F.min(F.when(kind == "view", F.col("us"))).alias("first_view_us"),
        F.min(F.when(kind == "purchase", F.col("us"))).alias("first_purchase_us"),
    )


SPARSE = f"""{SQL_CLICKS}, sparse AS (SELECT user_id, item_id,
    min(us) FILTER (WHERE event_type = 'view') AS first_view_us,
    min(us) FILTER (WHERE event_type = 'purchase') AS first_purchase_us
  FROM clickstream GROUP BY user_id, item_id),
audit AS (SELECT unnest(['user_id', 'item_id', 'first_view_us', 'first_purchase_us']) AS column_name,
    unnest([count(*) - count(user_id), count(*) - count(item_id), count(*) - count(first_view_us),
            count(*) - count(first_purchase_us)]) AS n_null, count(*) AS n FROM sparse)"""


@query(
    "a16_null_audit",
    with_sql(
        SPARSE,
        """SELECT column_name, n_null, CAST(n_null AS DOUBLE) / n AS null_rate FROM audit
WHERE n_null > 0""",
    ),
)
def a16(spark, d):
    return A.null_audit(_sparse_users(spark, d))


@query(
    "a17_label_balance",
    with_sql(
        sql_examples(),
        """SELECT count(*) AS n_examples, CAST(sum(label) AS BIGINT) AS positives,
  count(*) FILTER (WHERE label = 0) AS negatives,
  CAST(sum(label) AS DOUBLE) / count(*) AS positive_rate FROM examples""",
    ),
)
def a17(spark, d):
    return A.label_balance(training_examples(settle(sessionized(spark, d))))


PERCENTS = [0.0, 25.0, 50.0, 75.0, 95.0, 99.0, 100.0]


@query(
    "a18_score_percentiles",
    with_sql(
        f"""{sql_scored()},
ordered AS (SELECT score AS v, row_number() OVER (ORDER BY score) AS r, count(*) OVER () AS n
  FROM scored),
wanted AS (SELECT percent, n, (n - 1) * (percent / 100e0) AS pos FROM
  (SELECT unnest([0e0, 25e0, 50e0, 75e0, 95e0, 99e0, 100e0]) AS percent) p,
  (SELECT count(*) AS n FROM scored) t)""",
        """SELECT percent, lo.v + (coalesce(hi.v, lo.v) - lo.v) * (pos - floor(pos)) AS value
FROM wanted JOIN ordered lo ON lo.r = CAST(floor(pos) AS BIGINT) + 1
LEFT JOIN ordered hi ON hi.r = CAST(floor(pos) AS BIGINT) + 2""",
    ),
)
def a18(spark, d):
    return exact_percentiles(scored_examples(spark, d), "score", PERCENTS)


@query(
    "a19_score_histogram",
    with_sql(
        sql_scored(),
        """SELECT CAST(least(floor(score * 10), 9) AS BIGINT) AS bucket, count(*) AS n
FROM scored GROUP BY 1""",
    ),
)
def a19(spark, d):
    return score_histogram(scored_examples(spark, d))


@query(
    "a20_table_counts",
    """SELECT 'users' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'item_catalog', count(*) FROM part
UNION ALL SELECT 'clickstream_events', count(*) FROM events""",
)
def a20(spark, d):
    return table_counts(
        {
            "users": users(spark, d),
            "item_catalog": catalog(spark, d),
            "clickstream_events": clicks(spark, d),
        }
    )
