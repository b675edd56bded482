"""Sources and sinks, projections and filters, windows, ordering, sets, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartsight.functions.columns import (
    discounted_price,
    guarded_ratio,
    hours_since,
    minutes_between,
    session_name,
    whole_days_since,
)
from cartsight.operators import examples as X
from cartsight.operators import sessions as S
from cartsight.operators import summaries as A
from cartsight.operators.features import session_history
from cartsight.operators.history import history_at
from cartsight.operators.ranking import by_score, precision_at, with_global_rank
from cartsight.operators.skew import SkewParams, time_cuts
from cartsight.operators.split import events_of_sessions, split_name, ends_of
from cartsight.params import DAY_US
from cartsight.plans.training import target_and_features, zero_missing
from cartsight.queries.base import (
    SQL_CATALOG,
    SQL_CLICKS,
    catalog,
    clicks,
    query,
    scored_examples,
    scratch,
    sessionized,
    sql_events,
    sql_examples,
    sql_name,
    sql_scored,
    sql_sessions,
    users,
    with_sql,
)
from cartsight.sources.tables import (
    SESSIONIZER_COLUMNS,
    read_table,
    require_columns,
    settle,
    write_table,
)

EVENT_COLUMNS = ["event_id", "user_id", "us", "event_type", "item_id", "duration_seconds"]
CLICK_SELECT = "SELECT event_id, user_id, us, event_type, item_id, duration_seconds FROM clickstream"
BY_TYPE = """SELECT event_type, count(*) AS n, CAST(sum(us) AS BIGINT) AS sum_us,
  CAST(sum(item_id) AS BIGINT) AS sum_item FROM clickstream GROUP BY event_type"""


def _by_type(df):
    """Exact sums: BIGINT as in the SQL while all of a column fit, else DECIMAL (there the SQL's cast has no result)."""
    found = settle(
        df.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("us").cast("decimal(20,0)")).alias("sum_us"),
            F.sum(F.col("item_id").cast("decimal(20,0)")).alias("sum_item"),
        )
    )
    sums = ("sum_us", "sum_item")
    too_large = found.agg(*(F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("long").isNull()).alias(c) for c in sums)).first()
    return found.withColumns({c: F.col(c).cast("long") for c in sums if not too_large[c]})


# --- sources and sinks ----------------------------------------------------------------------------


@query("s1_parquet_scan", with_sql(SQL_CLICKS, CLICK_SELECT))
def s1(spark, d):
    return clicks(spark, d).select(*EVENT_COLUMNS)


@query("s2_parquet_sink", with_sql(SQL_CLICKS, BY_TYPE))
def s2(spark, d):
    path = scratch(spark, "parquet")
    write_table(clicks(spark, d), path)
    return _by_type(read_table(spark, path))


@query("s3_csv_sink", with_sql(SQL_CLICKS, BY_TYPE))
def s3(spark, d):
    path = scratch(spark, "csv")
    df = clicks(spark, d).select(*EVENT_COLUMNS)
    write_table(df, path, fmt="csv", rows_per_file=100_000)
    return _by_type(spark.read.schema(df.schema).option("header", True).csv(path))


@query(
    "s4_stage_tables",
    with_sql(sql_sessions(), "SELECT session_id, count(*) AS n FROM sess GROUP BY session_id"),
)
def s4(spark, d):
    path = scratch(spark, "stage")
    write_table(sessionized(spark, d), path)
    return A.group_counts(read_table(spark, path), "session_id")


@query(
    "s8_save_predictions",
    with_sql(sql_scored(), "SELECT user_id, item_id, session_seq, label, score FROM scored"),
)
def s8(spark, d):
    path = scratch(spark, "predictions")
    columns = ["user_id", "item_id", "session_seq", "label", "score"]
    write_table(scored_examples(spark, d).select(*columns), path)
    return read_table(spark, path)


@query(
    "s9_required_columns",
    with_sql(
        SQL_CLICKS,
        """SELECT count(*) AS n_rows, count(user_id) AS user_id, count(us) AS "timestamp",
  count(event_type) AS event_type, count(item_id) AS item_id FROM clickstream""",
    ),
)
def s9(spark, d):
    df = require_columns(clicks(spark, d), SESSIONIZER_COLUMNS)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in SESSIONIZER_COLUMNS]
    )


# --- projections, filters, predicates ----------------------------------------------------------------


@query("p1_type_filter", with_sql(SQL_CLICKS, CLICK_SELECT + " WHERE event_type = 'view'"))
def p1(spark, d):
    return clicks(spark, d).where(F.col("event_type") == "view").select(*EVENT_COLUMNS)


@query(
    "p2_history_filter",
    with_sql(
        sql_sessions(),
        """SELECT s.user_id, s.session_seq, count(e.us) AS n_before
FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM sess) s
LEFT JOIN sess e ON e.user_id = s.user_id AND e.us < s.session_end_us
GROUP BY s.user_id, s.session_seq""",
    ),
)
def p2(spark, d):
    """Events strictly before each session's end."""
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    probes = S.session_table(ev).select("user_id", "session_seq", F.col("end_us").alias("us"))
    acts = ev.select("user_id", "us", F.lit(1).alias("n_before"))
    return history_at(acts, probes, ["user_id"], cuts, sums=["n_before"]).drop("us")


@query(
    "p3_lookback_filter",
    with_sql(
        sql_sessions(),
        """SELECT s.user_id, s.session_seq,
  count(e.us) FILTER (WHERE e.us >= s.session_end_us - 604800000000) AS n_in_7d
FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM sess) s
LEFT JOIN sess e ON e.user_id = s.user_id AND e.us < s.session_end_us
GROUP BY s.user_id, s.session_seq""",
    ),
)
def p3(spark, d):
    """Events in [T - 7 d, T)."""
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    ends = F.array(F.col("end_us"), F.col("end_us") - 7 * DAY_US)
    probes = S.session_table(ev).select("user_id", "session_seq", F.explode(ends).alias("us"))
    acts = ev.select("user_id", "us", F.lit(1).alias("n"))
    seen = history_at(acts, probes, ["user_id"], cuts, sums=["n"])
    return seen.groupBy("user_id", "session_seq").agg((F.max("n") - F.min("n")).alias("n_in_7d"))


@query(
    "p4_membership_flag",
    with_sql(
        SQL_CLICKS,
        "SELECT event_id, event_type IN ('purchase', 'add_to_cart') AS is_boundary FROM clickstream",
    ),
)
def p4(spark, d):
    return S.boundary_flags(clicks(spark, d)).select("event_id", "is_boundary")


@query(
    "p5_key_set_filter",
    with_sql(
        sql_sessions(),
        """SELECT event_id, session_id FROM sess WHERE session_id IN
  (SELECT session_id FROM sess WHERE event_type = 'purchase')""",
    ),
)
def p5(spark, d):
    ev = settle(sessionized(spark, d))
    buying = ev.where(F.col("event_type") == "purchase")
    return events_of_sessions(ev, buying).select("event_id", "session_id")


@query(
    "p6_first_users",
    with_sql(
        SQL_CLICKS,
        """SELECT event_id, user_id FROM clickstream WHERE user_id IN (SELECT user_id FROM
  (SELECT user_id, us, event_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS r
   FROM clickstream) f WHERE r = 1 ORDER BY us, event_id LIMIT 100)""",
    ),
)
def p6(spark, d):
    """The feature is the sample: all events of the first 100 users to appear."""
    return A.first_users(clicks(spark, d), 100).select("event_id", "user_id")


@query(
    "p7_drop_columns",
    with_sql(SQL_CLICKS, "SELECT event_id, user_id, us, event_type, item_id FROM clickstream"),
)
def p7(spark, d):
    return clicks(spark, d).drop("timestamp", "duration_seconds")


@query(
    "p8_target_split",
    with_sql(
        f"{sql_examples()}, {SQL_CATALOG}",
        """SELECT label, c.current_price AS item_current_price, c.category AS item_category
FROM examples JOIN catalog c USING (item_id)""",
    ),
)
def p8(spark, d):
    from cartsight.operators.features import item_attributes

    examples = X.training_examples(settle(sessionized(spark, d)))
    full = item_attributes(examples, catalog(spark, d)).withColumn(
        "session_end_time", F.timestamp_micros("session_end_us")
    )
    return target_and_features(full).select("label", "item_current_price", "item_category")


@query(
    "p9_guarded_ratio",
    with_sql(
        SQL_CLICKS,
        """SELECT item_id, CASE WHEN v > 0 THEN CAST(p AS DOUBLE) / v ELSE 0e0 END AS ratio FROM
  (SELECT item_id, us // 86400000000 AS g, count(*) FILTER (WHERE event_type = 'view') AS v,
     count(*) FILTER (WHERE event_type = 'purchase') AS p FROM clickstream GROUP BY ALL) a""",
    ),
)
def p9(spark, d):
    kind = F.col("event_type")
    counts = clicks(spark, d).groupBy("item_id", F.floor(F.col("us") / DAY_US).alias("g")).agg(
        F.count_if(kind == "view").alias("v"), F.count_if(kind == "purchase").alias("p")
    )
    return counts.select("item_id", guarded_ratio(F.col("p"), F.col("v")).alias("ratio"))


@query(
    "p10_sentinel_default",
    with_sql(
        SQL_CLICKS,
        """SELECT user_id, coalesce((max(us) - max(us) FILTER (WHERE event_type = 'purchase'))
  / 3.6e9, 9999e0) AS hours FROM clickstream GROUP BY user_id""",
    ),
)
def p10(spark, d):
    bought = F.max(F.when(F.col("event_type") == "purchase", F.col("us")))
    return clicks(spark, d).groupBy("user_id").agg(hours_since(bought, F.max("us")).alias("hours"))


@query(
    "p11_boolean_to_int",
    with_sql(
        SQL_CATALOG,
        "SELECT item_id, CAST(discount_pct > 0 AS INTEGER) AS item_has_discount FROM catalog",
    ),
)
def p11(spark, d):
    flag = (F.col("discount_pct") > 0).cast("int").alias("item_has_discount")
    return catalog(spark, d).select("item_id", flag)


@query(
    "p12_split_predicates",
    with_sql(
        sql_events(30, split=True),
        "SELECT session_id, split, min(us) AS start_us FROM ev GROUP BY session_id, split",
    ),
)
def p12(spark, d):
    starts = S.session_info(sessionized(spark, d, 30)).select("session_id", "start_us")
    named = split_name(F.col("start_us"), ends_of(clicks(spark, d)))
    return starts.withColumn("split", named).where(F.col("split").isNotNull())


@query(
    "p15_zero_missing",
    with_sql(
        SQL_CLICKS,
        """SELECT user_id, coalesce(min(duration_seconds) FILTER (WHERE event_type = 'purchase'
  AND duration_seconds > 40), 0e0) AS session_length_minutes FROM clickstream GROUP BY user_id""",
    ),
)
def p15(spark, d):
    rare = (F.col("event_type") == "purchase") & (F.col("duration_seconds") > 40)
    shortest = F.min(F.when(rare, F.col("duration_seconds"))).alias("session_length_minutes")
    return zero_missing(clicks(spark, d).groupBy("user_id").agg(shortest))


# --- windows -----------------------------------------------------------------------------------------


@query(
    "w1_gap_to_previous",
    with_sql(
        SQL_CLICKS,
        """SELECT event_id, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap_us
FROM clickstream""",
    ),
)
def w1(spark, d):
    return S.gap_to_previous(clicks(spark, d)).select("event_id", "gap_us")


@query(
    "w2_new_session_flag",
    with_sql(
        sql_sessions(30),
        "SELECT event_id, gap_us IS NULL OR gap_us > 1800000000 AS is_new FROM gaps",
    ),
)
def w2(spark, d):
    gap = F.col("gap_us")
    is_new = gap.isNull() | (gap > 30 * 60_000_000)
    return S.gap_to_previous(clicks(spark, d)).select("event_id", is_new.alias("is_new"))


@query("w3_session_number", with_sql(sql_sessions(30), "SELECT event_id, session_seq FROM sess"))
def w3(spark, d):
    return sessionized(spark, d, 30).select("event_id", "session_seq")


@query(
    "w4_shifted_boundary",
    with_sql(
        SQL_CLICKS,
        """SELECT event_id, coalesce(lag(event_type IN ('purchase', 'add_to_cart'))
  OVER (PARTITION BY user_id ORDER BY us, event_id), true) AS starts FROM clickstream""",
    ),
)
def w4(spark, d):
    """A row starts an intent session when the row before it was a boundary, or there is none."""
    return S.shifted_boundary(clicks(spark, d)).select("event_id", "starts")


@query(
    "w5_session_ordinal",
    with_sql(
        sql_sessions(),
        """SELECT user_id, session_seq, row_number() OVER (PARTITION BY user_id ORDER BY session_seq)
  AS ordinal FROM (SELECT DISTINCT user_id, session_seq FROM sess) s""",
    ),
)
def w5(spark, d):
    return S.session_ordinals(sessionized(spark, d)).select("user_id", "session_seq", "ordinal")


@query(
    "w6_lookahead_sessions",
    with_sql(sql_examples(), "SELECT user_id, session_seq FROM placed WHERE rn <= n - 3"),
)
def w6(spark, d):
    sessions = S.session_table(settle(sessionized(spark, d)))
    return S.lookahead_span(sessions, 3).select("user_id", "session_seq")


WINDOW_COLUMNS = [f"views_count_{w}d" for w in (1, 7, 30)]


@query(
    "w7_trailing_windows",
    with_sql(
        sql_sessions(),
        "SELECT s.user_id, s.session_seq, "
        + ", ".join(
            f"count(e.us) FILTER (WHERE e.us >= s.session_end_us - {w * DAY_US}) AS views_count_{w}d"
            for w in (1, 7, 30)
        )
        + """ FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM sess) s
LEFT JOIN sess e ON e.user_id = s.user_id AND e.us < s.session_end_us AND e.event_type = 'view'
GROUP BY s.user_id, s.session_seq""",
    ),
)
def w7(spark, d):
    ev = settle(sessionized(spark, d))
    sessions = S.session_table(ev).select(
        "user_id", "session_seq", F.col("end_us").alias("session_end_us")
    )
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    return session_history(ev, sessions, cuts).select("user_id", "session_seq", *WINDOW_COLUMNS)


@query(
    "w8_last_event_before",
    with_sql(
        sql_sessions(),
        """SELECT s.user_id, s.session_seq, max(e.us) FILTER (WHERE e.event_type = 'purchase')
  AS last_purchase_us, min(e.us) AS first_us
FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM sess) s
LEFT JOIN sess e ON e.user_id = s.user_id AND e.us < s.session_end_us
GROUP BY s.user_id, s.session_seq""",
    ),
)
def w8(spark, d):
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    bought = F.when(F.col("event_type") == "purchase", F.col("us"))
    acts = ev.select("user_id", "us", bought.alias("last_purchase_us"), (-F.col("us")).alias("neg"))
    probes = S.session_table(ev).select("user_id", "session_seq", F.col("end_us").alias("us"))
    out = history_at(acts, probes, ["user_id"], cuts, maxes=["last_purchase_us", "neg"])
    return out.select("user_id", "session_seq", "last_purchase_us", (-F.col("neg")).alias("first_us"))


RANKED = """ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, user_id, item_id, session_seq)
  AS rank, count(*) OVER () AS n FROM scored)"""


@query(
    "w9_rank_by_score",
    with_sql(f"{sql_scored()}, {RANKED}", "SELECT user_id, item_id, session_seq, rank FROM ranked"),
)
def w9(spark, d):
    ranked = with_global_rank(scored_examples(spark, d), by_score())
    return ranked.select("user_id", "item_id", "session_seq", "rank")


@query(
    "w10_percent_rank",
    with_sql(
        SQL_CLICKS,
        """SELECT item_id, percent_rank() OVER (ORDER BY n) AS pr FROM
  (SELECT item_id, count(*) FILTER (WHERE event_type = 'view') AS n
   FROM clickstream GROUP BY item_id) a""",
    ),
)
def w10(spark, d):
    from cartsight.operators.declared import item_popularity

    return item_popularity(clicks(spark, d)).withColumnRenamed("item_popularity_score", "pr")


# --- ordering, top-k, sets ---------------------------------------------------------------------------


@query("o1_sort_user_time", with_sql(SQL_CLICKS, CLICK_SELECT + " ORDER BY user_id, us, event_id"))
def o1(spark, d):
    return clicks(spark, d).select(*EVENT_COLUMNS).orderBy("user_id", "us", "event_id")


@query("o2_sort_time", with_sql(SQL_CLICKS, CLICK_SELECT + " ORDER BY us, event_id"))
def o2(spark, d):
    return clicks(spark, d).select(*EVENT_COLUMNS).orderBy("us", "event_id")


@query("o3_head", with_sql(SQL_CLICKS, CLICK_SELECT + " ORDER BY us, event_id LIMIT 20"))
def o3(spark, d):
    """Display head: the limit is the feature."""
    return clicks(spark, d).select(*EVENT_COLUMNS).orderBy("us", "event_id").limit(20)


TOP_K = """tops AS (SELECT p.percent, CAST(floor(p.n * p.percent / 100e0) AS BIGINT) AS k, p.n, p.pos
  FROM (SELECT unnest([1, 5, 10, 20]) AS percent, n, pos FROM
    (SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM scored) t) p),
hits AS (SELECT t.percent, t.k, t.k = 0 AS whole_table, t.n, t.pos AS total_positives,
    CASE WHEN t.k > 0 THEN t.k ELSE t.n END AS taken,
    CAST(sum(r.label) AS BIGINT) AS positives_found
  FROM tops t JOIN ranked r ON r.rank <= CASE WHEN t.k > 0 THEN t.k ELSE t.n END
  GROUP BY ALL)"""
TOP_SQL = f"{sql_scored()}, {RANKED}, {TOP_K}"


@query(
    "o4_top_k_percent",
    with_sql(TOP_SQL, "SELECT percent, k, whole_table, positives_found, total_positives FROM hits"),
)
def o4(spark, d):
    return precision_at(scored_examples(spark, d)).select(
        "percent", "k", "whole_table", "positives_found", "total_positives"
    )


@query(
    "u1_union_all",
    with_sql(
        SQL_CLICKS,
        """SELECT event_id, item_id FROM clickstream WHERE event_type = 'view'
UNION ALL SELECT event_id, item_id FROM clickstream WHERE event_type = 'purchase'""",
    ),
)
def u1(spark, d):
    c = clicks(spark, d).select("event_id", "item_id", "event_type")
    parts = [c.where(F.col("event_type") == t).drop("event_type") for t in ("view", "purchase")]
    return parts[0].unionByName(parts[1])


@query(
    "u2_union_distinct",
    with_sql(
        sql_sessions(),
        """SELECT DISTINCT user_id, item_id, session_seq - o AS session_seq
FROM sess, (SELECT unnest([1, 2, 3]) AS o) t
WHERE event_type = 'purchase' AND session_seq - o > 0""",
    ),
)
def u2(spark, d):
    """Items bought in any of the three sessions after each session."""
    return X.acted_within(sessionized(spark, d), "purchase", 3)


@query(
    "u3_column_difference",
    with_sql(
        SQL_CLICKS,
        """SELECT 'session_id' AS missing_column, count(*) AS n_rows FROM clickstream""",
    ),
)
def u3(spark, d):
    """Declared columns that the raw event table lacks, beside its row count."""
    from cartsight.sources.tables import CLICKSTREAM

    c = clicks(spark, d)
    missing = sorted(set(CLICKSTREAM.names) - set(c.columns))
    return c.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*map(F.lit, missing))).alias("missing_column"), "n_rows"
    )


# --- scalar functions ---------------------------------------------------------------------------------


@query(
    "f1_session_name",
    with_sql(SQL_CLICKS, f"SELECT event_id, {sql_name('user_id', 'event_id')} AS name FROM clickstream"),
)
def f1(spark, d):
    return clicks(spark, d).select(
        "event_id", session_name(F.col("user_id"), F.col("event_id")).alias("name")
    )


@query(
    "f2_string_cast",
    with_sql(SQL_CLICKS, "SELECT event_id, CAST(user_id AS VARCHAR) AS user_text FROM clickstream"),
)
def f2(spark, d):
    return clicks(spark, d).select("event_id", F.col("user_id").cast("string").alias("user_text"))


@query(
    "f3_date_parse",
    """SELECT event_id, epoch_us(strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d')) AS day_us FROM events""",
)
def f3(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    day = F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd"), F.lit("yyyy-MM-dd"))
    from cartsight.sources.tables import with_micros

    return with_micros(events.select("event_id", day.alias("day")), "day", "day_us").drop("day")


@query(
    "f4_plus_days",
    "SELECT event_id, epoch_us(ts + INTERVAL 7 DAY) AS week_later_us FROM events",
)
def f4(spark, d):
    from cartsight.sources.tables import with_micros

    events = spark.read.parquet(f"{d}/events.parquet")
    later = events.select("event_id", (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("t"))
    return with_micros(later, "t", "week_later_us").drop("t")


TIME_UNITS = """SELECT user_id, {} AS value FROM clickstream GROUP BY user_id"""


@query("f5_minutes", with_sql(SQL_CLICKS, TIME_UNITS.format("(max(us) - min(us)) / 6e7")))
def f5(spark, d):
    return clicks(spark, d).groupBy("user_id").agg(
        minutes_between(F.min("us"), F.max("us")).alias("value")
    )


@query("f6_hours", with_sql(SQL_CLICKS, TIME_UNITS.format("(max(us) - min(us)) / 3.6e9")))
def f6(spark, d):
    return clicks(spark, d).groupBy("user_id").agg(
        hours_since(F.min("us"), F.max("us")).alias("value")
    )


@query(
    "f7_whole_days",
    with_sql(SQL_CLICKS, TIME_UNITS.format("(max(us) - min(us)) // 86400000000")),
)
def f7(spark, d):
    return clicks(spark, d).groupBy("user_id").agg(
        whole_days_since(F.min("us"), F.max("us")).alias("value")
    )


@query(
    "f8_truncate",
    with_sql(
        SQL_CLICKS,
        "SELECT item_id, CAST(floor(count(*) * 10 / 100e0) AS BIGINT) AS k FROM clickstream GROUP BY item_id",
    ),
)
def f8(spark, d):
    """Ten percent of each item's events, truncated."""
    k = F.floor(F.count(F.lit(1)) * 10 / F.lit(100.0)).cast("long")
    return clicks(spark, d).groupBy("item_id").agg(k.alias("k"))


@query(
    "f9_discount_price",
    with_sql(SQL_CATALOG, "SELECT item_id, current_price FROM catalog"),
)
def f9(spark, d):
    c = catalog(spark, d)
    price = discounted_price(F.col("base_price"), F.col("discount_pct")).alias("current_price")
    return c.select("item_id", price)


@query(
    "f10_format_date",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
)
def f10(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return events.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
