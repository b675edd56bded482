"""Metrics on scored examples, scoring, Spark ML, and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartsight.functions.columns import confidence_band, decide
from cartsight.operators import features as FE
from cartsight.operators import ranking as R
from cartsight.operators import scoring as K
from cartsight.operators.skew import join_lookup
from cartsight.plans import training as M
from cartsight.queries.base import (
    SQL_CATALOG,
    SQL_CLICKS,
    catalog,
    query,
    scored_examples,
    scratch,
    sessionized,
    split_events,
    sql_examples,
    sql_scored,
    sql_sessions,
    users,
    with_sql,
)
from cartsight.queries.core import sql_features
from cartsight.queries.tables import TOP_SQL
from cartsight.sources import fixtures
from cartsight.sources.tables import settle, with_micros
from cartsight.streaming import online as T

KEYS = ["user_id", "item_id", "session_seq"]

# --- metrics ------------------------------------------------------------------------------------------


def sql_areas(segment: str = "", source: str = "scored") -> str:
    """``areas``: average precision and ROC area, per segment."""
    seg = f"{segment}, " if segment else ""
    part = f"PARTITION BY {segment}" if segment else ""
    group = f"GROUP BY {segment}" if segment else ""
    return f"""by_score AS (
  SELECT {seg}score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM {source} GROUP BY {seg}score),
curve AS (
  SELECT *, CAST(sum(n) OVER w AS BIGINT) AS n_at, CAST(sum(pos) OVER w AS BIGINT) AS pos_at,
    sum(n - pos) OVER ({part}) AS neg_all
  FROM by_score WINDOW w AS ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
areas AS (
  SELECT {seg}CAST(sum(n) AS BIGINT) AS n_examples, CAST(sum(pos) AS BIGINT) AS n_positives,
    coalesce(CAST(sum(CAST(floor(CAST(pos_at AS DOUBLE) / n_at * 1e12) AS BIGINT) * pos) AS DOUBLE)
      / nullif(sum(pos) * 1e12, 0), 0e0) AS pr_auc,
    CAST(sum(pos * (2 * (neg_all - (n_at - pos_at)) + (n - pos))) AS DOUBLE)
      / nullif(CAST(2 * sum(pos) * sum(n - pos) AS DOUBLE), 0) AS roc_auc
  FROM curve {group})"""


@query(
    "m9_average_precision",
    with_sql(f"{sql_scored()}, {sql_areas()}", "SELECT n_examples, n_positives, pr_auc FROM areas"),
)
def m9(spark, d):
    return R.area_metrics(scored_examples(spark, d)).select("n_examples", "n_positives", "pr_auc")


@query("m10_roc_auc", with_sql(f"{sql_scored()}, {sql_areas()}", "SELECT roc_auc FROM areas"))
def m10(spark, d):
    return R.area_metrics(scored_examples(spark, d)).select("roc_auc")


TOP_RATIOS = """percent, CAST(positives_found AS DOUBLE) / taken AS precision,
  CASE WHEN total_positives > 0 THEN CAST(positives_found AS DOUBLE) / total_positives ELSE 0e0 END
    AS recall,
  CASE WHEN total_positives > 0 THEN (CAST(positives_found AS DOUBLE) / taken)
    / (CAST(total_positives AS DOUBLE) / n) ELSE 0e0 END AS lift"""


@query(
    "m11_precision_at_k",
    with_sql(TOP_SQL, f"SELECT percent, precision FROM (SELECT {TOP_RATIOS} FROM hits) a"),
)
def m11(spark, d):
    return R.precision_at(scored_examples(spark, d)).select("percent", "precision")


@query(
    "m12_positives_found",
    with_sql(TOP_SQL, "SELECT percent, positives_found, total_positives FROM hits"),
)
def m12(spark, d):
    tops = R.precision_at(scored_examples(spark, d))
    return tops.select("percent", "positives_found", "total_positives")


@query(
    "m13_recall_at_k",
    with_sql(TOP_SQL, f"SELECT percent, recall FROM (SELECT {TOP_RATIOS} FROM hits) a"),
)
def m13(spark, d):
    return R.precision_at(scored_examples(spark, d)).select("percent", "recall")


@query(
    "m14_lift_at_k",
    with_sql(TOP_SQL, f"SELECT percent, lift FROM (SELECT {TOP_RATIOS} FROM hits) a"),
)
def m14(spark, d):
    return R.precision_at(scored_examples(spark, d)).select("percent", "lift")


SQL_THRESHOLDS = f"""{sql_scored()},
grid AS (SELECT 0.001e0 + i * ((0.999e0 - 0.001e0) / 99) AS threshold
  FROM (SELECT unnest(range(100)) AS i) r),
counted AS (SELECT threshold, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos,
    count(*) FILTER (WHERE score >= threshold) AS predicted,
    count(*) FILTER (WHERE score >= threshold AND label = 1) AS true_positives
  FROM scored, grid GROUP BY threshold),
thresholds AS (SELECT threshold, true_positives, predicted - true_positives AS false_positives,
    pos - true_positives AS false_negatives, n - predicted - pos + true_positives AS true_negatives,
    CASE WHEN predicted > 0 THEN CAST(true_positives AS DOUBLE) / predicted ELSE 0e0 END AS precision,
    CASE WHEN pos > 0 THEN CAST(true_positives AS DOUBLE) / pos ELSE 0e0 END AS recall
  FROM counted)"""


@query("m15_threshold_table", with_sql(SQL_THRESHOLDS, "SELECT * FROM thresholds"))
def m15(spark, d):
    return R.threshold_table(scored_examples(spark, d), R.threshold_grid())


@query(
    "m15_best_threshold",
    with_sql(
        SQL_THRESHOLDS.replace("% 101) / 101e0 AS score", "% 101 + 60 * label) / 161e0 AS score"),
        """SELECT * FROM thresholds WHERE precision >= 0.1e0
ORDER BY recall DESC, precision DESC, threshold DESC LIMIT 1""",
    ),
)
def m15b(spark, d):
    """On a score that leans towards the label, so that the target precision is reached."""
    mixed = F.col("item_id") * 13 + F.col("session_seq") * 7 + F.col("user_id") * 3
    leaning = (mixed % 101 + 60 * F.col("label")) / F.lit(161.0)
    return R.best_threshold(settle(scored_examples(spark, d).withColumn("score", leaning)))


@query(
    "m16_precision_recall_curve",
    with_sql(
        f"{sql_scored()}, {sql_areas()}",
        """SELECT score AS threshold, CAST(pos_at AS DOUBLE) / n_at AS precision,
  CAST(pos_at AS DOUBLE) / CAST(sum(pos) OVER () AS DOUBLE) AS recall FROM curve""",
    ),
)
def m16(spark, d):
    return R.precision_recall_curve(scored_examples(spark, d))


@query(
    "m16_confusion_matrix",
    with_sql(
        sql_scored(),
        """SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n
FROM scored GROUP BY 1, 2""",
    ),
)
def m16b(spark, d):
    return R.confusion_matrix(scored_examples(spark, d))


@query(
    "m16_classification_report",
    with_sql(
        f"""{sql_scored()}, c AS (SELECT
  count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
  count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn FROM scored),
r AS (SELECT 0 AS label, tn AS h, fn AS f, fp AS m FROM c
  UNION ALL SELECT 1, tp, fp, fn FROM c)""",
        """SELECT label, coalesce(CAST(h AS DOUBLE) / nullif(h + f, 0), 0e0) AS precision,
  coalesce(CAST(h AS DOUBLE) / nullif(h + m, 0), 0e0) AS recall,
  coalesce(CAST(2 * h AS DOUBLE) / nullif(2 * h + f + m, 0), 0e0) AS f1, h + m AS support FROM r""",
    ),
)
def m16c(spark, d):
    return R.classification_report(scored_examples(spark, d))


def _two_models(spark, d):
    """The scored examples, and the same with the score turned round, as two models."""
    scored = scored_examples(spark, d)
    other = settle(scored.withColumn("score", F.lit(1.0) - F.col("score")))
    rows = [M.evaluate(scored, "forward"), M.evaluate(other, "reversed")]
    return rows[0].unionByName(rows[1])


@query(
    "m18_model_comparison",
    with_sql(
        f"""{sql_scored()},
both_models AS (SELECT 'forward' AS model, * FROM scored
  UNION ALL SELECT 'reversed', user_id, item_id, session_seq, session_id, label, 1e0 - score FROM scored),
{sql_areas('model', 'both_models')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY model
    ORDER BY score DESC, user_id, item_id, session_seq) AS rank,
  count(*) OVER (PARTITION BY model) AS n FROM both_models),
tops AS (SELECT model, avg(label) FILTER (WHERE rank <= CASE WHEN floor(n * 1 / 100e0) > 0
      THEN floor(n * 1 / 100e0) ELSE n END) AS precision_at_1_pct,
    avg(label) FILTER (WHERE rank <= CASE WHEN floor(n * 5 / 100e0) > 0
      THEN floor(n * 5 / 100e0) ELSE n END) AS precision_at_5_pct FROM ranked GROUP BY model)""",
        "SELECT model, pr_auc, precision_at_1_pct, precision_at_5_pct FROM areas JOIN tops USING (model)",
    ),
)
def m18(spark, d):
    names = ["pr_auc", "precision_at_1_pct", "precision_at_5_pct"]
    return R.compare_models(_two_models(spark, d), names)


SQL_PERSONA = f"""{sql_scored()},
segmented AS (SELECT scored.*, c_mktsegment AS persona FROM scored
  JOIN customer ON c_custkey = user_id)"""


def _segmented(spark, d):
    return settle(join_lookup(scored_examples(spark, d), users(spark, d), "user_id", "inner"))


@query(
    "m19_segment_areas",
    with_sql(
        f"{SQL_PERSONA}, {sql_areas('persona', 'segmented')}",
        "SELECT persona, n_examples, n_positives, pr_auc, roc_auc FROM areas",
    ),
)
def m19(spark, d):
    return R.area_metrics(_segmented(spark, d), ["persona"])


@query(
    "m19_segment_precision",
    with_sql(
        f"""{SQL_PERSONA},
ranked AS (SELECT *, row_number() OVER (PARTITION BY persona
    ORDER BY score DESC, user_id, item_id, session_seq) AS rank,
  count(*) OVER (PARTITION BY persona) AS n,
  CAST(sum(label) OVER (PARTITION BY persona) AS BIGINT) AS total_positives FROM segmented),
tops AS (SELECT *, CAST(floor(n * percent / 100e0) AS BIGINT) AS k
  FROM ranked, (SELECT unnest([1, 5, 10, 20]) AS percent) p)""",
        """SELECT persona, percent, k, k = 0 AS whole_table, CAST(sum(label) AS BIGINT) AS positives_found,
  total_positives, CAST(sum(label) AS DOUBLE) / CASE WHEN k > 0 THEN k ELSE n END AS precision
FROM tops WHERE rank <= CASE WHEN k > 0 THEN k ELSE n END GROUP BY persona, percent, k, n, total_positives""",
    ),
)
def m19b(spark, d):
    return R.precision_at_per_segment(_segmented(spark, d), "persona")


@query(
    "o5_top_predictions",
    with_sql(
        f"{sql_scored()}, {SQL_CATALOG}",
        """SELECT user_id, item_id, category AS item_category, current_price AS item_current_price,
  label, score FROM (SELECT * FROM scored ORDER BY score DESC, user_id, item_id, session_seq LIMIT 20) t
JOIN catalog USING (item_id)""",
    ),
)
def o5(spark, d):
    """The report is the 20 best rows."""
    top = R.top_predictions(scored_examples(spark, d), 20)
    full = FE.item_attributes(top, catalog(spark, d))
    return full.select(
        "user_id", "item_id", "item_category", "item_current_price", "label", "score"
    )


# --- scoring --------------------------------------------------------------------------------------------

SQL_REQUESTS = f"""{sql_sessions()}, {SQL_CATALOG},
requests AS (
  SELECT s.user_id, s.item_id, s.session_seq, current_price AS item_price,
    base_price AS item_base_price, discount_pct AS item_discount_pct, category AS item_category,
    max(duration_seconds) FILTER (WHERE event_type = 'view') - 20 AS days_since_last_view,
    count(*) FILTER (WHERE event_type = 'view') AS view_count_7d,
    CASE WHEN count(*) FILTER (WHERE event_type = 'add_to_cart') > 0
      THEN CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
        / count(*) FILTER (WHERE event_type = 'add_to_cart') END AS cart_to_purchase_ratio
  FROM sess s JOIN catalog USING (item_id)
  GROUP BY s.user_id, s.item_id, s.session_seq, current_price, base_price, discount_pct, category)"""


def _requests(spark, d):
    """Scoring rows, one per (user, item, session): some break a rule, many lack optional values."""
    kind = F.col("event_type")
    carts, buys = F.count_if(kind == "add_to_cart"), F.count_if(kind == "purchase")
    rows = sessionized(spark, d).groupBy(*KEYS).agg(
        (F.max(F.when(kind == "view", F.col("duration_seconds"))) - 20).alias("days_since_last_view"),
        F.count_if(kind == "view").alias("view_count_7d"),
        F.try_divide(buys.cast("double"), carts.cast("double")).alias("cart_to_purchase_ratio"),
    )
    items = catalog(spark, d).select(
        "item_id",
        F.col("current_price").alias("item_price"),
        F.col("base_price").alias("item_base_price"),
        F.col("discount_pct").alias("item_discount_pct"),
        F.col("category").alias("item_category"),
    )
    return join_lookup(rows, items, "item_id", "inner")


def _planted_rules() -> list[tuple[str, str, str, str]]:
    """(rule, column, SQL of a value that breaks it, SQL of what a valid row meets), in the order of the rules."""
    out = [(f"{c} is required", c, "NULL", f"{c} IS NOT NULL") for c in K.REQUIRED_COLUMNS]
    out += [(f"{c} must be >= 0", c, "-1", f"{c} >= 0") for c in K.RECENCY_COLUMNS + K.COUNT_COLUMNS + K.DURATION_COLUMNS]
    out += [(f"{c} must be in [0, 1]", c, "2", f"{c} BETWEEN 0 AND 1") for c in K.RATIO_COLUMNS]
    out += [(f"{c} must be > 0", c, "0", f"{c} > 0") for c in K.PRICE_COLUMNS]
    out.append(("item_discount_pct must be in [0, 100]", "item_discount_pct", "101", "item_discount_pct BETWEEN 0 AND 100"))
    return [*out, ("session_item_count must be >= 1", "session_item_count", "0", "session_item_count >= 1")]


PLANTED = _planted_rules()
GIVEN = (
    "user_id", "item_id", "item_price", "item_base_price", "item_discount_pct", "item_category", "days_since_last_view",
    "view_count_7d", "cart_to_purchase_ratio",
)


def _sql_planted() -> str:
    """``planted``: the requests with their defaults, each k-th row breaking the k-th rule beside its own faults."""
    zero = {c: "0" for c in K.COUNT_COLUMNS + K.RATIO_COLUMNS + K.DURATION_COLUMNS + ("item_discount_pct",)}
    zero["session_item_count"] = "1"
    columns = []
    for c in dict.fromkeys(c for _, c, _, _ in PLANTED):
        value = f"coalesce({c}, {zero[c]})" if c in GIVEN and c in zero else c if c in GIVEN else zero.get(c, "NULL::DOUBLE")
        cases = " ".join(f"WHEN {k} THEN {bad}" for k, (_, other, bad, _) in enumerate(PLANTED) if other == c)
        columns.append(f"CASE (user_id * 7 + item_id * 13 + session_seq) % {len(PLANTED) + 1} {cases} ELSE {value} END AS {c}")
    return f"{SQL_REQUESTS},\nplanted AS (SELECT session_seq, {', '.join(columns)} FROM requests)"


@query(
    "p13_row_validation",
    with_sql(
        _sql_planted(),
        "SELECT user_id, item_id, session_seq, reject_reason = '' AS valid, nullif(reject_reason, '') AS reject_reason "
        "FROM (SELECT *, concat_ws('; ', "
        + ", ".join(f"CASE WHEN NOT ({ok}) THEN '{name}' END" for name, _, _, ok in PLANTED)
        + ") AS reject_reason FROM planted) r",
    ),
)
def p13(spark, d):
    """Rows that break each of the rules, beside rows that break none."""
    rows = K.with_defaults(_requests(spark, d))
    code = (F.col("user_id") * 7 + F.col("item_id") * 13 + F.col("session_seq")) % (len(PLANTED) + 1)
    rows = rows.withColumn("_code", code)
    for k, (_, column, bad, _) in enumerate(PLANTED):
        value = F.expr(bad).cast(rows.schema[column].dataType)
        rows = rows.withColumn(column, F.when(F.col("_code") == k, value).otherwise(F.col(column)))
    return K.validate(rows).select(*KEYS, "valid", "reject_reason")


@query(
    "p14_row_defaults",
    with_sql(
        SQL_REQUESTS,
        """SELECT user_id, item_id, session_seq, days_since_last_view, view_count_7d,
  coalesce(cart_to_purchase_ratio, 0e0) AS cart_to_purchase_ratio, CAST(0 AS BIGINT) AS cart_count_30d,
  CAST(1 AS BIGINT) AS session_item_count, CAST(NULL AS DOUBLE) AS days_since_last_cart FROM requests""",
    ),
)
def p14(spark, d):
    return K.with_defaults(_requests(spark, d)).select(
        *KEYS,
        "days_since_last_view",
        "view_count_7d",
        "cart_to_purchase_ratio",
        "cart_count_30d",
        "session_item_count",
        "days_since_last_cart",
    )


@query(
    "k1_align_features",
    with_sql(
        f"{sql_features(480, split=True)}, train AS (SELECT DISTINCT item_category FROM features WHERE split = 'train')",
        "SELECT split, user_id, item_id, session_seq, "
        + ", ".join(
            f"{'0e0' if c == 'views_count_1d' else f'coalesce(CAST({c} AS DOUBLE), 0e0)'} AS {c}" for c in M.numeric_columns()
        )
        + ", (SELECT count(*) FROM train) AS n_dummies,"
        " CASE WHEN item_category IN (SELECT item_category FROM train) THEN 1e0 ELSE 0e0 END AS dummies_set FROM features",
    ),
)
def k1(spark, d):
    """The columns of a stored model, in its order; a column that the rows lack becomes 0."""
    features, model = _linear(spark, d)
    path = scratch(spark, "model")
    M.save_model(model, path)
    names = M.feature_names(M.load_model(path))
    numeric = M.numeric_columns()
    kinds = [n.partition("=")[2] for n in names[len(numeric) :]]
    dummies = K.category_dummies(kinds)
    rows = K.align(features.drop("views_count_1d"), {n: None for n in numeric} | dummies, ["split", *KEYS])
    total = sum((F.col(f"`{n}`") for n in dummies), F.lit(0.0))
    return rows.select(
        "split", *KEYS, *numeric, F.lit(len(kinds)).cast("long").alias("n_dummies"), total.alias("dummies_set")
    )


def _probabilities(spark, d):
    return scored_examples(spark, d).select(*KEYS, "label", "score")


@query(
    "k3_threshold",
    with_sql(
        sql_scored(),
        """SELECT user_id, item_id, session_seq, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored""",
    ),
)
def k3(spark, d):
    return _probabilities(spark, d).select(*KEYS, decide(F.col("score"), 0.5).alias("prediction"))


SQL_BAND = """CASE WHEN score < 0.3e0 OR score > 0.7e0 THEN 'high'
  WHEN score < 0.4e0 OR score > 0.6e0 THEN 'medium' ELSE 'low' END AS confidence"""


@query(
    "k4_confidence_band",
    with_sql(sql_scored(), f"SELECT user_id, item_id, session_seq, {SQL_BAND} FROM scored"),
)
def k4(spark, d):
    return _probabilities(spark, d).select(
        *KEYS, confidence_band(F.col("score")).alias("confidence")
    )


@query(
    "k5_result_rows",
    with_sql(
        sql_scored(),
        f"""SELECT user_id, item_id, CAST(score >= 0.5 AS INTEGER) AS prediction, score AS probability,
  {SQL_BAND}, 'v1' AS model_version FROM scored""",
    ),
)
def k5(spark, d):
    return K.score_rows(_probabilities(spark, d), F.col("score"), "v1")


@query(
    "k6_threshold_sweep",
    with_sql(
        sql_scored(),
        """SELECT threshold, count(*) AS n_rows, count(*) FILTER (WHERE score >= threshold) AS n_positive
FROM scored, (SELECT unnest([0.3e0, 0.5e0, 0.7e0]) AS threshold) t GROUP BY threshold""",
    ),
)
def k6(spark, d):
    return K.threshold_sweep(_probabilities(spark, d))


# --- Spark ML --------------------------------------------------------------------------------------------

SQL_FEATURES = f"""{sql_features(480, split=True)},
train AS MATERIALIZED (SELECT * FROM features WHERE split = 'train')"""
NUMERIC = M.numeric_columns()


def _features(spark, d):
    """Features of every split at the richer gap."""
    split = settle(split_events(spark, d).select("split", *FE.EVENT_COLUMNS))
    return settle(FE.build_features(split, catalog(spark, d), ("split", "user_id")))


def _part(features, name):
    return features.where(F.col("split") == name).drop("split")


def _rounded(column):
    """Six places, and no negative zero, so that two engines' sums agree."""
    return F.round(column, 6) + F.lit(0.0)


@query(
    "m1_standardize",
    with_sql(
        SQL_FEATURES,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(avg({c}), 6) + 0e0 AS mean, round(stddev_pop({c}), 6) + 0e0 AS std FROM train"
            for c in NUMERIC
        ),
    ),
)
def m1(spark, d):
    """Means and population deviations on train that standardisation uses."""
    stats = M.scaling_stats(_part(_features(spark, d), "train"), NUMERIC)
    return stats.select("column_name", _rounded("mean").alias("mean"), _rounded("std").alias("std"))


@query(
    "m2_one_hot",
    with_sql(
        f"""{SQL_FEATURES},
seen AS (SELECT DISTINCT item_category FROM train WHERE item_category != (SELECT min(category) FROM catalog))""",
        """SELECT split, user_id, item_id, session_seq, CAST(36 + (SELECT count(*) FROM seen) AS INTEGER) AS width,
  CASE WHEN item_category IN (SELECT item_category FROM seen) THEN 1e0 ELSE 0e0 END AS hot FROM features""",
    ),
)
def m2(spark, d):
    """Size of the vector and number of one-hot slots set, on every split; training lacks the first category."""
    features, first = _features(spark, d), catalog(spark, d).agg(F.min("category")).first()[0]
    train = _part(features, "train").where(F.col("item_category") != first)
    v = _prepared(features, train)
    after = F.slice("v", len(NUMERIC) + 1, F.greatest(F.size("v") - len(NUMERIC), F.lit(1)))
    hot = F.aggregate(after, F.lit(0.0), lambda a, x: a + x)
    return v.select("split", *KEYS, F.size("v").alias("width"), hot.alias("hot"))


@query(
    "m3_assemble",
    with_sql(
        f"""{SQL_FEATURES},
stats AS (SELECT {", ".join(f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(NUMERIC))} FROM train)""",
        "SELECT split, user_id, item_id, session_seq, "
        + ", ".join(
            f"CASE WHEN s_{i} = 0 THEN 0e0 ELSE round(({c} - m_{i}) / s_{i}, 6) + 0e0 END AS z_{c}" for i, c in enumerate(NUMERIC)
        )
        + " FROM features, stats",
    ),
)
def m3(spark, d):
    """The standardised inputs of every example, by train's means and deviations."""
    features = _features(spark, d)
    v = _prepared(features, _part(features, "train"))
    return v.select("split", *KEYS, *(_rounded(F.get("v", F.lit(i))).alias(f"z_{c}") for i, c in enumerate(NUMERIC)))


def _prepared(features, train):
    """All examples with their input vector, prepared as ``train`` asks."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fitted = Pipeline(stages=M.preparation(train.count())).fit(train)
    return fitted.transform(features).select("split", *KEYS, vector_to_array("features").alias("v"))


def _linear(spark, d):
    features = _features(spark, d)
    return features, M.fit_linear(_part(features, "train"))


def sql_checked(*verdicts: str) -> str:
    """All examples, each with its label and the named verdicts, which must hold."""
    return with_sql(
        sql_examples(480, split=True),
        "SELECT split, user_id, item_id, session_seq, label, " + ", ".join(f"true AS {v}" for v in verdicts) + " FROM examples",
    )


def _checked(scored, **verdicts):
    """The examples with verdicts; ``is_probability`` is one of each row's score."""
    fine = F.coalesce(F.col("score").between(0.0, 1.0), F.lit(False))
    return scored.select("split", *KEYS, "label", fine.alias("is_probability"), *(v.alias(n) for n, v in verdicts.items()))


def _above_base(scored):
    """Average precision on the examples used for fitting exceeds their share of positives."""
    row = area_row(scored.where("split = 'train'"))
    return F.lit(bool(row["pr_auc"] > row["n_positives"] / row["n_examples"]))


def area_row(scored):
    return R.area_metrics(settle(scored.select(*KEYS, "label", "score"))).first()


@query("m4_logistic_regression", sql_checked("is_probability", "at_optimum"))
def m4(spark, d):
    """Scores of the linear model, and whether its loss is flat where the fit ended."""
    features, model = _linear(spark, d)
    slope = M.linear_slope(model, _part(features, "train"))
    return _checked(M.predict(model, features), at_optimum=F.lit(slope < 1e-3))


@query("m5_boosted_trees", sql_checked("is_probability", "above_base"))
def m5(spark, d):
    features = _features(spark, d)
    model = M.fit_boosted(_part(features, "train"), _part(features, "val"))
    scored = settle(M.predict(model, features))
    return _checked(scored, above_base=_above_base(scored))


@query("m6_second_ensemble", sql_checked("is_probability", "above_base"))
def m6(spark, d):
    features = _features(spark, d)
    scored = settle(M.predict(M.fit_forest(_part(features, "train")), features))
    return _checked(scored, above_base=_above_base(scored))


@query(
    "m7_parameter_grid",
    with_sql(
        sql_examples(480, split=True),
        """SELECT max_depth, step_size, rounds, pos_weight, n_val, true AS is_share, true AS keeps_trees, true AS best_is_highest
FROM (SELECT unnest([4, 6, 8, 10]) AS max_depth) a, (SELECT unnest([0.01e0, 0.05e0, 0.1e0, 0.2e0]) AS step_size) b,
  (SELECT unnest([100, 200, 300, 500]) AS rounds) c, (SELECT unnest([5000e0, 10000e0, 15000e0, 20000e0]) AS pos_weight) e,
  (SELECT count(*) AS n_val FROM examples WHERE split = 'val') n""",
    ),
)
def m7(spark, d):
    """Every declared point: its score on val is a share, it keeps some of its rounds, and the best one is the highest."""
    features = _features(spark, d)
    train, val = _part(features, "train"), _part(features, "val")
    tuned = M.tune(train, val)
    highest = tuned.agg(F.max("pr_auc").alias("high"), F.max(F.when(F.col("is_best"), F.col("pr_auc"))).alias("best"), F.count_if("is_best").alias("n")).first()
    one_best = highest["n"] == 1 and highest["best"] == highest["high"]
    return tuned.select(
        *M.GRID_POINT,
        F.lit(val.count()).cast("long").alias("n_val"),
        F.col("pr_auc").between(0.0, 1.0).alias("is_share"),
        F.col("n_trees").between(1, F.col("rounds")).alias("keeps_trees"),
        F.lit(one_best).alias("best_is_highest"),
    )


@query(
    "m8_undersampling",
    with_sql(
        sql_examples(480, split=True),
        """SELECT label, count(*) AS n FROM examples WHERE split = 'train' AND (label = 1 OR
  ('0x' || substr(md5('42:' || user_id || ':' || item_id || ':' || session_seq), 1, 8))::BIGINT % 10000 < 1000)
GROUP BY label""",
    ),
)
def m8(spark, d):
    train = _part(_features(spark, d), "train")
    return M.undersample(train, 0.1, keys=KEYS).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m8_class_weights",
    with_sql(
        sql_examples(),
        """SELECT label, count(*) AS n, CAST(max(total) AS DOUBLE) / (2e0 * count(*)) AS weight
FROM (SELECT label, count(*) OVER () AS total FROM examples) a GROUP BY label""",
    ),
)
def m8b(spark, d):
    scored = scored_examples(spark, d)
    weight = M.balanced_weights(M.class_counts(scored))
    return scored.withColumn("weight", weight).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")
    )


def _importance(spark, d):
    features = _features(spark, d)
    train, val = _part(features, "train"), _part(features, "val")
    return settle(M.feature_importance(M.fit_boosted(train, val), train))


@query(
    "m17_feature_importance",
    with_sql(
        SQL_FEATURES,
        "\nUNION ALL ".join(f"SELECT '{c}' AS feature, true AS is_share, true AS sums_to_one" for c in NUMERIC)
        + """
UNION ALL SELECT DISTINCT 'item_category=' || item_category, true, true FROM train""",
    ),
)
def m17(spark, d):
    """A row for each input; importances are shares of 1."""
    rows = _importance(spark, d)
    total = rows.agg(F.sum("importance")).first()[0]
    fine = F.col("importance").between(0.0, 1.0) & (F.col("n_splits") >= 0)
    return rows.select("feature", fine.alias("is_share"), F.lit(abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("o6_top_features")
def o6(spark, d):
    """The ten inputs that split most nodes of the boosted trees; a fitted model has no SQL (see its test)."""
    rows = _importance(spark, d)
    return settle(M.top_features(rows, 10))


@query("s5_s6_model_store", sql_checked("is_probability", "same_as_fitted"))
def s5(spark, d):
    """Save, load, and score with the loaded model as with the fitted one."""
    features, model = _linear(spark, d)
    path = scratch(spark, "model")
    M.save_model(model, path)
    again = M.predict(M.load_model(path), features)
    both = M.predict(model, again.withColumnRenamed("score", "loaded"))
    same = F.abs(F.col("score") - F.col("loaded")) < 1e-12
    return _checked(both, same_as_fitted=same)


@query(
    "k2_model_scores",
    with_sql(
        sql_examples(480, split=True),
        "SELECT user_id, item_id, true AS decided, true AS banded, 'logistic-1' AS model_version FROM examples",
    ),
)
def k2(spark, d):
    """Decision and band follow from the probability of each scored row."""
    features, model = _linear(spark, d)
    out = K.score_rows(M.predict(model, features), F.col("score"), "logistic-1")
    p = F.col("probability")
    sure = F.abs(p - 0.5)
    band = F.when(sure > F.lit(0.7) - 0.5, "high").when(sure > F.lit(0.6) - 0.5, "medium").otherwise("low")
    return out.select(
        "user_id",
        "item_id",
        (F.col("prediction") == F.when(p >= 0.5, 1).otherwise(0)).alias("decided"),
        (F.col("confidence") == band).alias("banded"),
        "model_version",
    )


METRIC_NAMES = [
    "pr_auc", "roc_auc", *(f"{m}_at_{k}_pct" for m in ("precision", "positives_found", "recall", "lift") for k in (1, 5, 10, 20))
]


@query(
    "l4_holdout_evaluation",
    with_sql(
        sql_examples(480, split=True),
        f"""SELECT model, split, metric, true AS in_range,
  CASE metric WHEN 'n_examples' THEN n WHEN 'n_positives' THEN pos END AS exact
FROM (SELECT split, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS pos FROM examples GROUP BY split) e,
  (SELECT unnest(['logistic', 'boosted']) AS model) b,
  (SELECT unnest({["n_examples", "n_positives", *METRIC_NAMES]}) AS metric) m""",
    ),
)
def l4(spark, d):
    """Metrics of both models on every split: counts as they are, the others by their range."""
    features, linear = _linear(spark, d)
    boosted = M.fit_boosted(_part(features, "train"), _part(features, "val"))
    out = None
    for title, model in (("logistic", linear), ("boosted", boosted)):
        for name in ("train", "val", "test"):
            rows = M.evaluate(M.predict(model, _part(features, name)), title).withColumn("split", F.lit(name))
            out = rows if out is None else out.unionByName(rows)
    count = F.col("metric").isin("n_examples", "n_positives")
    wide = F.col("metric").rlike("^(n_|positives_found|lift)")
    # a split without positives (or negatives) has no area, recall or lift
    fine = F.col("value").isNull() | ((F.col("value") >= 0) & (wide | (F.col("value") <= 1)))
    return out.select("model", "split", "metric", fine.alias("in_range"), F.when(count, F.col("value")).alias("exact"))


# --- streaming --------------------------------------------------------------------------------------------


def _live(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return T.read_stream(spark, d, schema, only="events.parquet")


@query(
    "s7_latest_model",
    """SELECT max(strftime(ts, '%Y%m%d')) AS version, true AS is_last_path, true AS loads FROM events""",
)
def s7(spark, d):
    """The newest of the models stored under their versions, here the first and the last day of the events."""
    days = spark.read.parquet(f"{d}/events.parquet").agg(*(F.date_format(f("ts"), "yyyyMMdd") for f in (F.min, F.max))).first()
    _, model = _linear(spark, d)
    folder = scratch(spark, "models")
    stored = [(day, f"{folder}/{day}") for day in days]
    for _, path in stored:
        M.save_model(model, path)
    last = M.latest_model(spark.createDataFrame(stored, "version string, path string")).first()
    loads = len(M.load_model(last["path"]).stages) == len(model.stages)
    return spark.createDataFrame(
        [(last["version"], last["path"] == stored[1][1], loads)], "version string, is_last_path boolean, loads boolean"
    )


@query(
    "t1_stream_scoring",
    with_sql(
        sql_examples(480, split=True),
        "SELECT user_id, item_id, true AS is_probability, true AS decided, 'logistic-1' AS model_version FROM examples",
    ),
)
def t1(spark, d):
    """All examples as a stream of feature rows, scored by a stored model."""
    features, model = _linear(spark, d)
    path, folder = scratch(spark, "model"), scratch(spark, "live")
    M.save_model(model, path)
    features.drop("split").write.parquet(folder)
    live = T.read_stream(spark, folder, spark.read.parquet(folder).schema)
    out = T.drain(T.score_stream_with_model(M.load_model(path), live, "logistic-1"), scratch(spark, "stream"), scratch(spark, "state"))
    p = F.col("probability")
    return out.select(
        "user_id",
        "item_id",
        F.coalesce(p.between(0.0, 1.0), F.lit(False)).alias("is_probability"),
        (F.col("prediction") == F.when(p >= 0.5, 1).otherwise(0)).alias("decided"),
        "model_version",
    )


@query(
    "t2_stream_sessions",
    with_sql(
        sql_sessions(30),
        """SELECT user_id, min(us) AS start_us, max(us) AS end_us, count(*) AS n_events,
  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase
FROM sess GROUP BY user_id, session_seq
HAVING max(us) + 1800000000 <= ((SELECT max(us) FROM clickstream) // 1000) * 1000 - 3600000000""",
    ),
)
def t2(spark, d):
    """Sessions closed by the final watermark, one hour behind the newest event."""
    rows = with_micros(_live(spark, d), "ts").select(
        "user_id", F.timestamp_micros("us").alias("timestamp"), "event_type"
    )
    stream = T.session_stream(rows)
    return T.drain(stream, scratch(spark, "stream"), scratch(spark, "state"))


SQL_INTENT = f"""{SQL_CLICKS},
lagged AS (SELECT *, coalesce(lag(event_type IN ('purchase', 'add_to_cart'))
    OVER (PARTITION BY user_id ORDER BY us, event_id), true) AS starts FROM clickstream),
numbered AS (SELECT *, CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER
    (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq
  FROM lagged),
so_far AS (SELECT user_id, event_id, us, session_seq, min(us) OVER s AS start_us, count(*) OVER s AS n_events,
    count(*) FILTER (WHERE event_type = 'view') OVER s AS items_viewed,
    count(*) FILTER (WHERE event_type = 'scroll') OVER s AS items_scrolled,
    count(*) FILTER (WHERE event_type = 'add_to_cart') OVER s AS items_carted,
    event_type IN ('purchase', 'add_to_cart') AS closes
  FROM numbered WINDOW s AS (PARTITION BY user_id, session_seq ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))"""
# events that the last watermark, one hour behind the newest, has passed
PASSED = "us < ((SELECT max(us) FROM clickstream) // 1000) * 1000 - 3600000000"


def _live_intents(spark, d):
    stream = T.intent_stream(fixtures.clicks_of(_live(spark, d)))
    with T.rocksdb_state(spark):
        return T.drain(stream, scratch(spark, "stream"), scratch(spark, "state"))


@query(
    "s8_replay_safe_sink",
    with_sql(SQL_CLICKS, "SELECT event_id, user_id, us, event_type FROM clickstream"),
)
def s8(spark, d):
    """Every event is sent twice; the table has it once, and a batch that is written again changes nothing."""
    live = fixtures.clicks_of(_live(spark, d)).select("event_id", "user_id", "us", "event_type", "timestamp")
    twice = live.withColumn("_sent", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_sent")
    out = scratch(spark, "stream")
    stored = T.replay_safe(twice, out, scratch(spark, "state"), ["event_id"], "timestamp")
    last = stored.agg(F.max("batch")).first()[0]
    if last is not None:
        T.write_batch(out)(settle(stored.where(F.col("batch") == last).drop("batch")), last)
    return spark.read.parquet(out).select("event_id", "user_id", "us", "event_type")


@query("t2_live_session_so_far", with_sql(SQL_INTENT, f"SELECT * FROM so_far WHERE {PASSED}"))
def t2_so_far(spark, d):
    """The intent session so far at every event that the watermark has passed."""
    return _live_intents(spark, d)


@query(
    "t2_live_intent_sessions",
    with_sql(
        SQL_INTENT,
        f"""SELECT user_id, session_seq, start_us, us AS end_us, n_events, items_viewed, items_scrolled, items_carted
FROM so_far WHERE closes AND {PASSED}""",
    ),
)
def t2_intent(spark, d):
    """Intent sessions that have closed, from the live events."""
    return T.intent_sessions(_live_intents(spark, d))
