"""Sessionization, split, joins, examples and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartsight.operators import examples as X
from cartsight.operators import features as FE
from cartsight.operators import sessions as S
from cartsight.operators.history import history_at
from cartsight.operators.skew import SkewParams, join_lookup, time_cuts
from cartsight.operators.split import (
    assert_no_leakage,
    ends_of,
    events_of_sessions,
    split_calendar,
    split_violations,
)
from cartsight.params import DAY_US, Params, SessionParams
from cartsight.plans.run import run
from cartsight.plans.stages import Stages, refresh_days
from cartsight.queries.base import (
    GAP,
    SQL_CALENDAR,
    SQL_CATALOG,
    SQL_CLICKS,
    catalog,
    clicks,
    query,
    sessionized,
    split_events,
    sql_events,
    sql_examples,
    sql_name,
    sql_sessions,
    with_sql,
)
from cartsight.sources.tables import settle

SPLIT_USER = ("split", "user_id")

# --- sessionization and split -----------------------------------------------------------------------


@query(
    "e1_time_sessions",
    with_sql(sql_sessions(30), "SELECT event_id, session_id, session_start_us FROM sess"),
)
def e1(spark, d):
    return sessionized(spark, d, 30).select("event_id", "session_id", "session_start_us")


@query(
    "e2_intent_sessions",
    with_sql(
        f"""{SQL_CLICKS},
lagged AS (SELECT *, coalesce(lag(event_type IN ('purchase', 'add_to_cart'))
    OVER (PARTITION BY user_id ORDER BY us, event_id), true) AS starts FROM clickstream),
numbered AS (SELECT *, CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER
    (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq
  FROM lagged)""",
        f"""SELECT event_id, {sql_name('user_id', 'session_seq', 'intent_session')} AS session_id,
  min(us) OVER (PARTITION BY user_id, session_seq) AS session_start_us FROM numbered""",
    ),
)
def e2(spark, d):
    out = S.sessions_by_intent(clicks(spark, d))
    return out.select("event_id", "session_id", "session_start_us")


@query("e3_split_dates", with_sql(f"{SQL_CLICKS}, {SQL_CALENDAR}", "SELECT * FROM calendar"))
def e3(spark, d):
    return split_calendar(clicks(spark, d))


@query(
    "e4_temporal_split",
    with_sql(sql_events(30, split=True), "SELECT event_id, session_id, split FROM ev"),
)
def e4(spark, d):
    return split_events(spark, d, 30).select("event_id", "session_id", "split")


@query(
    "e5_leakage_assertions",
    with_sql(
        f"""{sql_events(30, split=True)},
planted AS (SELECT session_start_us, CASE WHEN split = 'val' AND user_id % 7 = 0 THEN 'train'
    WHEN split = 'train' AND user_id % 7 = 1 THEN 'val' WHEN split = 'val' AND user_id % 7 = 2 THEN 'test'
    ELSE split END AS split FROM ev)""",
        """SELECT count(*) FILTER (WHERE split = 'train' AND session_start_us > train_end_us) AS late_train,
  count(*) FILTER (WHERE split = 'val' AND session_start_us <= train_end_us) AS early_val,
  count(*) FILTER (WHERE split = 'test' AND session_start_us <= val_end_us) AS early_test,
  CASE WHEN count(*) FILTER (WHERE split = 'train') = 0 THEN 1 ELSE 0 END AS empty_train
FROM planted, calendar""",
    ),
)
def e5(spark, d):
    """Counts on a split into which some users' events are put wrongly; a sound split passes the assertion."""
    sound, ends = settle(split_events(spark, d, 30)), ends_of(clicks(spark, d))
    assert_no_leakage(sound, ends)
    user, name = F.col("user_id") % 7, F.col("split")
    wrong = F.when((name == "val") & (user == 0), "train").when((name == "train") & (user == 1), "val")
    return split_violations(sound.withColumn("split", wrong.when((name == "val") & (user == 2), "test").otherwise(name)), ends)


# --- joins ------------------------------------------------------------------------------------------


@query(
    "j1_events_to_catalog",
    with_sql(
        f"{SQL_CLICKS}, {SQL_CATALOG}",
        "SELECT event_id, c.item_id, category FROM clickstream c LEFT JOIN catalog USING (item_id)",
    ),
)
def j1(spark, d):
    joined = FE.with_category(clicks(spark, d), catalog(spark, d))
    return joined.select("event_id", "item_id", "category")


@query(
    "j2_example_attributes",
    with_sql(
        f"{sql_examples()}, {SQL_CATALOG}",
        """SELECT user_id, item_id, session_seq, current_price AS item_current_price,
  base_price AS item_base_price, category AS item_category FROM examples JOIN catalog USING (item_id)""",
    ),
)
def j2(spark, d):
    examples = X.training_examples(settle(sessionized(spark, d)))
    known = FE.require_known_items(FE.item_attributes(examples, catalog(spark, d)))
    return known.select(
        "user_id", "item_id", "session_seq", "item_current_price", "item_base_price", "item_category"
    )


REPEATED = """listed AS (
  SELECT *, item_id % 3 AS line FROM catalog
  UNION ALL SELECT item_id, 'again', base_price * 2, 50e0, base_price, (item_id + 1) % 3 FROM catalog WHERE item_id % 2 = 0
  UNION ALL SELECT item_id, 'late', 1e0, 0e0, 1e0, NULL FROM catalog WHERE item_id % 5 = 0),
firsts AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY line NULLS LAST) = 1)"""


@query(
    "j2_first_catalog_row",
    with_sql(
        f"{sql_examples()}, {SQL_CATALOG}, {REPEATED}",
        """SELECT user_id, item_id, session_seq, current_price AS item_current_price, category AS item_category,
  (SELECT count(*) FROM (SELECT item_id FROM listed GROUP BY item_id HAVING count(*) > 1) r) AS n_repeated
FROM examples JOIN firsts USING (item_id)""",
    ),
)
def j2_first(spark, d):
    """Examples with the first of several catalog rows of their item: as many examples as without repeats."""
    items = catalog(spark, d)
    again = items.where("item_id % 2 = 0").selectExpr(
        "item_id", "'again' AS category", "base_price * 2 AS base_price", "50D AS discount_pct", "base_price AS current_price", "(item_id + 1) % 3 AS line"
    )
    late = items.where("item_id % 5 = 0").selectExpr(
        "item_id", "'late' AS category", "1D AS base_price", "0D AS discount_pct", "1D AS current_price", "CAST(NULL AS BIGINT) AS line"
    )
    listed = items.select("item_id", "category", "base_price", "discount_pct", "current_price", (F.col("item_id") % 3).alias("line"))
    listed = settle(listed.unionByName(again).unionByName(late))
    examples = X.training_examples(settle(sessionized(spark, d)))
    known = FE.require_known_items(FE.item_attributes(examples, FE.first_match(listed, "line")))
    n = FE.repeated_items(listed).count()
    return known.select(
        "user_id", "item_id", "session_seq", "item_current_price", "item_category", F.lit(n).cast("long").alias("n_repeated")
    )


@query(
    "j3_session_semi_join",
    with_sql(
        sql_sessions(),
        """SELECT event_id, session_id FROM sess WHERE session_id IN
  (SELECT session_id FROM sess WHERE event_type = 'view')""",
    ),
)
def j3(spark, d):
    ev = settle(sessionized(spark, d))
    viewing = ev.where(F.col("event_type") == "view")
    return events_of_sessions(ev, viewing).select("event_id", "session_id")


PROBE = "(SELECT DISTINCT user_id, item_id, session_seq, session_end_us FROM examples)"


def _history_counts(spark, d, keys, ev=None):
    ev = ev if ev is not None else settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    probes = X.training_examples(ev).select(
        "user_id", "item_id", "session_seq", F.col("session_end_us").alias("us")
    )
    acts = ev.select(*keys, "us", F.lit(1).alias("n_before"))
    return history_at(acts, probes, keys, cuts, sums=["n_before"]).drop("us")


@query(
    "j4_point_in_time_join",
    with_sql(
        sql_examples(),
        f"""SELECT p.user_id, p.item_id, p.session_seq, count(e.us) AS n_before FROM {PROBE} p
LEFT JOIN ev e ON e.user_id = p.user_id AND e.us < p.session_end_us GROUP BY ALL""",
    ),
)
def j4(spark, d):
    return _history_counts(spark, d, ["user_id"])


@query(
    "j5_windowed_history_join",
    with_sql(
        sql_examples(),
        """SELECT p.user_id, p.session_seq, """
        + ", ".join(
            f"""count(e.us) FILTER (WHERE e.us >= p.session_end_us - {w * DAY_US}
  AND e.event_type = '{t}') AS {n}_count_{w}d"""
            for w in (1, 7, 30)
            for t, n in (("scroll", "scrolls"), ("purchase", "purchases"))
        )
        + """ FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM examples) p
LEFT JOIN ev e ON e.user_id = p.user_id AND e.us < p.session_end_us GROUP BY ALL""",
    ),
)
def j5(spark, d):
    columns = [f"{n}_count_{w}d" for w in (1, 7, 30) for n in ("scrolls", "purchases")]
    return _session_history(spark, d).select("user_id", "session_seq", *columns)


@query(
    "j6_lookahead_join",
    with_sql(
        sql_examples(),
        "SELECT user_id, item_id, session_seq, label FROM examples",
    ),
)
def j6(spark, d):
    examples = X.training_examples(settle(sessionized(spark, d)))
    return examples.select("user_id", "item_id", "session_seq", "label")


@query(
    "j7_label_membership",
    with_sql(
        sql_examples(),
        "SELECT user_id, item_id, session_seq FROM examples WHERE label = 1",
    ),
)
def j7(spark, d):
    """Candidates that are in the set of items bought soon after."""
    ev = settle(sessionized(spark, d))
    bought = X.acted_within(ev, "purchase", 3)
    keys = ["user_id", "item_id", "session_seq"]
    return X.candidates(ev).join(bought, keys, "left_semi").select(*keys)


@query(
    "j8_last_event_as_of",
    with_sql(
        sql_examples(),
        "SELECT p.user_id, p.session_seq, "
        + ", ".join(
            f"max(e.us) FILTER (WHERE e.event_type = '{t}') AS last_{t}_us"
            for t in ("view", "scroll", "add_to_cart", "purchase")
        )
        + """ FROM (SELECT DISTINCT user_id, session_seq, session_end_us FROM examples) p
LEFT JOIN ev e ON e.user_id = p.user_id AND e.us < p.session_end_us GROUP BY ALL""",
    ),
)
def j8(spark, d):
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    kinds = ("view", "scroll", "add_to_cart", "purchase")
    acts = ev.select(
        "user_id",
        "us",
        *[F.when(F.col("event_type") == t, F.col("us")).alias(f"last_{t}_us") for t in kinds],
    )
    probes = X.training_examples(ev).select(
        "user_id", "session_seq", F.col("session_end_us").alias("us")
    )
    out = history_at(
        acts, probes.distinct(), ["user_id"], cuts, maxes=[f"last_{t}_us" for t in kinds]
    )
    return out.drop("us")


@query(
    "j9_item_history_join",
    with_sql(
        sql_examples(),
        f"""SELECT p.user_id, p.item_id, p.session_seq, count(e.us) AS n_before FROM {PROBE} p
LEFT JOIN ev e ON e.user_id = p.user_id AND e.item_id = p.item_id AND e.us < p.session_end_us
GROUP BY ALL""",
    ),
)
def j9(spark, d):
    return _history_counts(spark, d, ["user_id", "item_id"])


@query(
    "j10_category_history_join",
    with_sql(
        f"{sql_examples()}, {SQL_CATALOG}",
        f"""SELECT p.user_id, p.item_id, p.session_seq, count(e.us) AS n_before
FROM {PROBE} p JOIN catalog pc ON pc.item_id = p.item_id
LEFT JOIN (SELECT ev.*, category FROM ev JOIN catalog USING (item_id)) e
  ON e.user_id = p.user_id AND e.category = pc.category AND e.us < p.session_end_us
GROUP BY ALL""",
    ),
)
def j10(spark, d):
    ev = settle(FE.with_category(sessionized(spark, d), catalog(spark, d)))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    examples = join_lookup(
        X.training_examples(ev), catalog(spark, d).select("item_id", "category"), "item_id"
    )
    probes = examples.select(
        "user_id", "item_id", "category", "session_seq", F.col("session_end_us").alias("us")
    )
    acts = ev.select("user_id", "category", "us", F.lit(1).alias("n_before"))
    out = history_at(acts, probes, ["user_id", "category"], cuts, sums=["n_before"])
    return out.drop("us", "category")


# --- examples and features ------------------------------------------------------------------------------

EXAMPLE_COLUMNS = ["user_id", "item_id", "session_id", "session_seq", "session_end_us", "label"]


@query(
    "x1_training_examples",
    with_sql(
        sql_examples(30),
        f"SELECT {', '.join(EXAMPLE_COLUMNS)} FROM examples",
    ),
)
def x1(spark, d):
    return X.training_examples(settle(sessionized(spark, d, 30))).select(*EXAMPLE_COLUMNS)


@query(
    "x1_training_examples_480",
    with_sql(sql_examples(), f"SELECT {', '.join(EXAMPLE_COLUMNS)} FROM examples"),
)
def x1_480(spark, d):
    return X.training_examples(settle(sessionized(spark, d))).select(*EXAMPLE_COLUMNS)


def _session_history(spark, d):
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    sessions = S.lookahead_span(S.session_table(ev), 3).where(F.col("n_views") > 0)
    ends = sessions.select("user_id", "session_seq", F.col("end_us").alias("session_end_us"))
    return FE.session_history(ev, ends, cuts)


def _counted(kinds):
    return [
        f"{expr} FILTER (WHERE e.event_type = '{t}') AS {name}" for t, expr, name in kinds
    ]


def sql_history() -> str:
    """``hist``: the user-level features of every (split, user, session) that has examples."""
    four = [("view", "views"), ("scroll", "scrolls"), ("add_to_cart", "cart_adds"), ("purchase", "purchases")]
    parts = ["min(e.us) AS first_us"]
    parts += [f"max(e.us) FILTER (WHERE e.event_type = '{t}') AS last_{t}" for t, _ in four]
    for w in (1, 7, 30):
        recent = f"e.us >= s.t - {w * DAY_US}"
        parts += [
            f"count(e.us) FILTER (WHERE {recent} AND e.event_type = '{t}') AS {n}_count_{w}d"
            for t, n in four
        ]
        parts.append(
            f"count(DISTINCT e.item_id) FILTER (WHERE {recent} AND e.event_type = 'view')"
            f" AS unique_items_viewed_{w}d"
        )
    hours = ",\n  ".join(
        f"coalesce((t - last_{t}) / 3.6e9, 9999e0) AS hours_since_last_{t}" for t, _ in four
    )

    def ratio(a: str, b: str, name: str) -> str:
        return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0e0 END AS {name}"

    return f"""points AS (
  SELECT DISTINCT split, user_id, session_seq, session_end_us AS t FROM examples),
raw AS (
  SELECT s.split, s.user_id, s.session_seq, s.t, {', '.join(parts)}
  FROM points s LEFT JOIN ev e ON e.split = s.split AND e.user_id = s.user_id AND e.us < s.t
  GROUP BY s.split, s.user_id, s.session_seq, s.t),
hist AS (
  SELECT *, {hours},
  coalesce((t - first_us) // 86400000000, 0) AS days_since_registration,
  {ratio('scrolls_count_7d', 'views_count_7d', 'view_to_scroll_ratio_7d')},
  {ratio('cart_adds_count_7d', 'scrolls_count_7d', 'scroll_to_cart_ratio_7d')},
  {ratio('purchases_count_30d', 'cart_adds_count_30d', 'cart_to_purchase_ratio_30d')}
  FROM raw)"""


SQL_CONTEXT = """context AS (
  SELECT split, user_id, session_seq, (max(us) - min(us)) / 6e7 AS session_length_minutes,
    count(*) FILTER (WHERE event_type = 'view') AS items_viewed_session,
    count(*) FILTER (WHERE event_type = 'scroll') AS items_scrolled_session,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS items_carted_session,
    count(DISTINCT item_id) AS unique_items_session
  FROM ev GROUP BY split, user_id, session_seq)"""

SQL_AFFINITY = f"""{SQL_CATALOG},
affinity AS (
  SELECT p.split, p.user_id, p.item_id, p.session_seq,
    count(e.us) FILTER (WHERE e.item_id = p.item_id AND e.event_type = 'view')
      AS times_viewed_this_item,
    count(e.us) FILTER (WHERE e.item_id = p.item_id AND e.event_type = 'scroll')
      AS times_scrolled_this_item,
    count(e.us) FILTER (WHERE e.item_id = p.item_id AND e.event_type = 'add_to_cart')
      AS times_carted_this_item,
    count(e.us) FILTER (WHERE ec.category = pc.category AND e.event_type = 'view')
      AS times_viewed_this_category
  FROM examples p JOIN catalog pc ON pc.item_id = p.item_id
  LEFT JOIN ev e ON e.split = p.split AND e.user_id = p.user_id AND e.us < p.session_end_us
  LEFT JOIN catalog ec ON ec.item_id = e.item_id
  GROUP BY ALL)"""

HISTORY_GROUPS = {
    "x2_recency": ["hours_since_last_view", "hours_since_last_scroll"]
    + ["hours_since_last_add_to_cart", "hours_since_last_purchase"],
    "x3_tenure_days": ["days_since_registration"],
    "x4_event_counts": [
        f"{n}_count_{w}d" for w in (1, 7, 30) for n in ("views", "scrolls", "cart_adds", "purchases")
    ],
    "x5_unique_items_viewed": [f"unique_items_viewed_{w}d" for w in (1, 7, 30)],
    "x6_view_to_scroll": ["view_to_scroll_ratio_7d"],
    "x7_scroll_to_cart": ["scroll_to_cart_ratio_7d"],
    "x8_cart_to_purchase": ["cart_to_purchase_ratio_30d"],
}
CONTEXT_GROUPS = {
    "x9_session_length": ["session_length_minutes"],
    "x10_session_counts": ["items_viewed_session", "items_scrolled_session", "items_carted_session"],
    "x11_session_unique_items": ["unique_items_session"],
}


def _register_history(name: str, columns: list[str]) -> None:
    select = f"SELECT user_id, session_seq, {', '.join(columns)} FROM hist"

    @query(name, with_sql(f"{sql_examples()}, {sql_history()}", select))
    def history_query(spark, d):
        return _session_history(spark, d).select("user_id", "session_seq", *columns)


def _register_context(name: str, columns: list[str]) -> None:
    select = f"SELECT user_id, session_seq, {', '.join(columns)} FROM context"

    @query(name, with_sql(f"{sql_events()}, {SQL_CONTEXT}", select))
    def context_query(spark, d):
        context = FE.session_context(sessionized(spark, d))
        return context.select("user_id", "session_seq", *columns)


for _name, _columns in HISTORY_GROUPS.items():
    _register_history(_name, _columns)
for _name, _columns in CONTEXT_GROUPS.items():
    _register_context(_name, _columns)

ITEM_TIMES = ["times_viewed_this_item", "times_scrolled_this_item", "times_carted_this_item"]
KEYS = ["user_id", "item_id", "session_seq"]


@query(
    "x12_item_affinity",
    with_sql(
        f"{sql_examples()}, {SQL_AFFINITY}",
        f"SELECT {', '.join(KEYS + ITEM_TIMES)} FROM affinity",
    ),
)
def x12(spark, d):
    ev = settle(sessionized(spark, d))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    return FE.item_affinity(ev, X.training_examples(ev), cuts).select(*KEYS, *ITEM_TIMES)


@query(
    "x13_category_affinity",
    with_sql(
        f"{sql_examples()}, {SQL_AFFINITY}",
        f"SELECT {', '.join(KEYS)}, times_viewed_this_category FROM affinity",
    ),
)
def x13(spark, d):
    ev = settle(FE.with_category(sessionized(spark, d), catalog(spark, d)))
    cuts = time_cuts(ev, "user_id", "us", SkewParams())
    examples = FE.item_attributes(X.training_examples(ev), catalog(spark, d))
    out = FE.category_affinity(ev, examples, cuts)
    return out.select(*KEYS, "times_viewed_this_category")


ITEM_COLUMNS = {
    "x14_item_prices": [
        ("current_price", "item_current_price"),
        ("base_price", "item_base_price"),
        ("discount_pct", "item_discount_pct"),
    ],
    "x15_item_has_discount": [("CAST(discount_pct > 0 AS INTEGER)", "item_has_discount")],
    "x16_item_category": [("category", "item_category")],
}


def _register_item(name: str, columns: list[tuple[str, str]]) -> None:
    exprs = ", ".join(f"{e} AS {n}" for e, n in columns)
    select = f"SELECT {', '.join(KEYS)}, {exprs} FROM examples JOIN catalog USING (item_id)"

    @query(name, with_sql(f"{sql_examples()}, {SQL_CATALOG}", select))
    def item_query(spark, d):
        examples = X.training_examples(settle(sessionized(spark, d)))
        out = FE.require_known_items(FE.item_attributes(examples, catalog(spark, d)))
        return out.select(*KEYS, *[n for _, n in columns])


for _name, _item_columns in ITEM_COLUMNS.items():
    _register_item(_name, _item_columns)


def sql_features(gap: int = GAP, split: bool = False) -> str:
    """``features``: all 37, with keys and label."""
    named = ", ".join(
        c for c in FE.feature_columns() if not c.startswith("item_") and c != "item_category"
    )
    return f"""{sql_examples(gap, split)},
{sql_history()},
{SQL_CONTEXT},
{SQL_AFFINITY},
features AS (
  SELECT x.split, x.user_id, x.item_id, x.session_seq, x.session_id, x.session_end_us, x.label,
    {named}, current_price AS item_current_price, base_price AS item_base_price,
    discount_pct AS item_discount_pct, CAST(discount_pct > 0 AS INTEGER) AS item_has_discount,
    category AS item_category
  FROM examples x JOIN hist USING (split, user_id, session_seq)
  JOIN context USING (split, user_id, session_seq)
  JOIN affinity USING (split, user_id, item_id, session_seq)
  JOIN catalog ON catalog.item_id = x.item_id)"""


FEATURE_SELECT = "SELECT {}user_id, item_id, session_seq, session_id, session_end_us, label, " + ", ".join(
    FE.feature_columns()
)


@query("x_all_features", with_sql(sql_features(), FEATURE_SELECT.format("") + " FROM features"))
def x_all(spark, d):
    features = FE.build_features(settle(sessionized(spark, d)), catalog(spark, d))
    return features.drop("session_end_time")


@query(
    "l3_features_per_split",
    with_sql(sql_features(30, split=True), FEATURE_SELECT.format("split, ") + " FROM features"),
)
def l3(spark, d):
    split = settle(split_events(spark, d, 30))
    features = FE.build_features(split, catalog(spark, d), SPLIT_USER)
    return features.drop("session_end_time")


@query(
    "l2_single_stages",
    with_sql(
        sql_examples(480, split=True),
        """SELECT split, count(*) AS n_examples, CAST(sum(label) AS BIGINT) AS positives
FROM examples GROUP BY split""",
    ),
)
def l2(spark, d):
    """Sessionize, split and label as separate stages, each stored and read back."""
    from cartsight.plans.run import sessionize_stage, split_stage
    from cartsight.queries.base import scratch

    out, params = scratch(spark, "stages"), Params(session=SessionParams(inactivity_minutes=GAP))
    sessions = sessionize_stage(clicks(spark, d), params, out)
    split = split_stage(sessions, params, out)
    return X.training_examples(split, SPLIT_USER).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_examples"), F.sum("label").alias("positives")
    )


@query(
    "l1_full_run",
    with_sql(
        sql_features(480, split=True),
        """SELECT split, count(*) AS n_examples, CAST(sum(label) AS BIGINT) AS positives,
  CAST(sum(views_count_7d) AS BIGINT) AS views_7d,
  CAST(sum(unique_items_viewed_30d) AS BIGINT) AS items_30d,
  CAST(sum(times_viewed_this_category) AS BIGINT) AS category_views,
  CAST(2 AS BIGINT) AS n_models, CAST(count(*) AS DOUBLE) AS least_scored, CAST(count(*) AS DOUBLE) AS most_scored
FROM features GROUP BY split""",
    ),
)
def l1(spark, d):
    """One call from raw events to trained and measured models: features and models summed up per split."""
    from cartsight.queries.base import scratch

    params = Params(session=SessionParams(inactivity_minutes=GAP))
    result = run(spark, clicks(spark, d), catalog(spark, d), params, scratch(spark, "run"))
    models = result.metrics.where("metric = 'n_examples'").groupBy("split").agg(
        F.count_distinct("model").alias("n_models"),
        F.min("value").alias("least_scored"),
        F.max("value").alias("most_scored"),
    )
    sums = result.features.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.sum("label").alias("positives"),
        F.sum("views_count_7d").alias("views_7d"),
        F.sum("unique_items_viewed_30d").alias("items_30d"),
        F.sum("times_viewed_this_category").alias("category_views"),
    )
    return sums.join(models, "split")


@query(
    "l2_unchanged_stage",
    with_sql(
        sql_sessions(),
        """SELECT user_id, count(DISTINCT session_seq) AS n_sessions, count(*) AS n_events, true AS ran_first, false AS ran_again
FROM sess GROUP BY user_id""",
    ),
)
def l2_unchanged(spark, d):
    """Sessions per user as a stage run twice: the second time nothing has changed, and the stored version answers."""
    from cartsight.queries.base import scratch

    params = SessionParams(inactivity_minutes=GAP)
    stages = Stages(spark, scratch(spark, "stages"))

    def build():
        ev = S.sessions_by_gap(clicks(spark, d), params)
        return ev.groupBy("user_id").agg(F.count_distinct("session_seq").alias("n_sessions"), F.count(F.lit(1)).alias("n_events"))

    runs = [stages.run("sessions_per_user", [f"{d}/events.parquet"], params, build) for _ in range(2)]
    return runs[1][0].withColumns({"ran_first": F.lit(runs[0][1]), "ran_again": F.lit(runs[1][1])})


@query(
    "l2_refreshed_days",
    with_sql(
        SQL_CLICKS,
        """SELECT day, n_rows, CASE WHEN day <= (min(day) OVER () + max(day) OVER ()) // 2 THEN 'kept' ELSE 'new' END AS done
FROM (SELECT us // 86400000000 AS day, count(*) AS n_rows FROM clickstream GROUP BY 1) a""",
    ),
)
def l2_days(spark, d):
    """A table by day of which the first half is there when the whole comes: only the later days are written."""
    from cartsight.queries.base import scratch

    path = scratch(spark, "days")
    rows = clicks(spark, d).withColumn("day", F.expr(f"us div {DAY_US}"))
    ends = rows.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    if ends["a"] is None:
        return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("done", F.lit("kept"))
    middle = (ends["a"] + ends["b"]) // 2
    refresh_days(rows.where(F.col("day") <= middle), path, "day")
    done = refresh_days(rows, path, "day")
    said = spark.createDataFrame(list(done.items()), "day long, done string")  # one row per day
    counts = spark.read.parquet(f"{path}/rows").groupBy(F.col("day").cast("long").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(said, "day", "left").select("day", "n_rows", F.coalesce("done", F.lit("kept")).alias("done"))


@query(
    "l5_parameters",
    with_sql(
        sql_examples(1440),
        "SELECT user_id, item_id, session_seq, label FROM examples",
    ),
)
def l5(spark, d):
    """The same examples under another session parameter."""
    params = Params(session=SessionParams(inactivity_minutes=1440))
    ev = settle(S.sessions_by_gap(clicks(spark, d), params.session, params.skew))
    return X.training_examples(ev, params=params.feature).select(*KEYS, "label")
