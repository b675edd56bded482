"""Features that the feature configuration declares beyond the base set, and train-only item
aggregates.

All are point-in-time like the base features. Money and durations are summed as integer millionths, so
that results do not depend on row order. ``ev_cat`` is the event table with ``category``,
``current_price`` and ``discount_pct`` attached; ``sessions`` has ``by``, session_seq and
session_end_us.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import guarded_ratio, one_if
from cartsight.operators.examples import USER, flag_examples
from cartsight.operators.features import category_affinity
from cartsight.operators.history import distinct_changes, history_at, window_probes
from cartsight.operators.ordered import running
from cartsight.operators.ranking import FIXED_POINT, value_cuts
from cartsight.operators.sessions import session_table
from cartsight.operators.skew import Cuts, SkewParams, join_lookup, time_cuts
from cartsight.params import ADD_TO_CART, DAY_US, PURCHASE, VIEW
from cartsight.sources.tables import settle

MICRO = 1_000_000


def micros(x: Column) -> Column:
    return F.floor(x * F.lit(float(MICRO)) + F.lit(0.5)).cast("long")


def mean_of_micros(total: Column, n: Column) -> Column:
    """Mean of a sum in millionths; 0.0 when there is nothing to average."""
    return F.coalesce(
        F.try_divide(total.cast("double"), n.cast("double") * F.lit(float(MICRO))), F.lit(0.0)
    )


def with_item_details(ev: DataFrame, catalog: DataFrame, skew: SkewParams = SkewParams()) -> DataFrame:
    details = catalog.select("item_id", "category", "current_price", "discount_pct")
    return join_lookup(ev, details, "item_id", skew=skew)


def _per_session(
    changes: DataFrame,
    sessions: DataFrame,
    cuts: Cuts,
    by: Sequence[str],
    windows: Sequence[int],
    sums: Sequence[str],
) -> DataFrame:
    """Cumulative sums at T, and as ``<name>_in_<w>`` over [T - w, T), per session."""
    keys = [*by, "session_seq"]
    probes = window_probes(sessions.select(*keys, "session_end_us"), windows)
    answered = history_at(changes, probes, by, cuts, sums=sums)

    def at(tag: int, c: str) -> Column:
        return F.max(F.when(F.col("_tag") == tag, F.col(c)))

    return answered.groupBy(*keys, "session_end_us").agg(
        *[at(0, c).alias(c) for c in sums],
        *[(at(0, c) - at(w, c)).alias(f"{c}_in_{w}") for w in windows for c in sums],
    )


def unique_categories_viewed(
    ev_cat: DataFrame,
    sessions: DataFrame,
    cuts: Cuts,
    by: Sequence[str] = USER,
    windows_days: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    views = ev_cat.where(F.col("event_type") == VIEW)
    moves = distinct_changes(views, by, "category", windows_days, cuts, "c")
    probes = sessions.select(*by, "session_seq", F.col("session_end_us").alias("us"))
    out = history_at(moves, probes, by, cuts, sums=[f"c{w}" for w in windows_days])
    return out.select(
        *by,
        "session_seq",
        *[F.col(f"c{w}").alias(f"unique_categories_viewed_{w}d") for w in windows_days],
    )


def bounce_rate(ev: DataFrame, cuts: Cuts, by: Sequence[str] = USER) -> DataFrame:
    """Share of the user's sessions ended before T that have exactly one view."""
    table = session_table(ev, by)
    ended = table.select(
        *by,
        F.col("end_us").alias("us"),
        F.lit(1).alias("ended"),
        one_if(F.col("n_views") == 1).alias("bounced"),
    )
    probes = table.select(*by, "session_seq", F.col("end_us").alias("us"))
    out = history_at(ended, probes, by, cuts, sums=["ended", "bounced"])
    rate = guarded_ratio(F.col("bounced"), F.col("ended")).alias("session_bounce_rate")
    return out.select(*by, "session_seq", rate)


def time_per_item(
    ev: DataFrame, sessions: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Seconds spent in the last 7 days over the distinct items touched in them."""
    moves = distinct_changes(ev, by, "item_id", [7], cuts, "items_")
    spent = ev.select(
        *by, "us", F.coalesce(micros(F.col("duration_seconds")), F.lit(0)).alias("spent")
    )
    out = _per_session(
        spent.unionByName(moves, allowMissingColumns=True),
        sessions,
        cuts,
        by,
        [7],
        ["spent", "items_7"],
    )
    mean = mean_of_micros(F.col("spent_in_7"), F.col("items_7")).alias("avg_time_per_item_7d")
    return out.select(*by, "session_seq", mean)


def price_levels(
    ev_cat: DataFrame, sessions: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Mean price of the items viewed, and of those purchased, in the last 30 days."""
    price = micros(F.col("current_price"))
    acts = ev_cat.where(
        F.col("event_type").isin(VIEW, PURCHASE) & F.col("current_price").isNotNull()
    )
    viewed, bought = F.col("event_type") == VIEW, F.col("event_type") == PURCHASE
    changes = acts.select(
        *by,
        "us",
        one_if(viewed).alias("v"),
        one_if(bought).alias("b"),
        F.when(viewed, price).otherwise(0).alias("vp"),
        F.when(bought, price).otherwise(0).alias("bp"),
    )
    out = _per_session(changes, sessions, cuts, by, [30], ["v", "b", "vp", "bp"])
    return out.select(
        *by,
        "session_seq",
        mean_of_micros(F.col("vp_in_30"), F.col("v_in_30")).alias("user_avg_price_viewed_30d"),
        mean_of_micros(F.col("bp_in_30"), F.col("b_in_30")).alias("user_avg_price_purchased_30d"),
    )


def price_ratio(price: Column, user_avg: Column) -> Column:
    """Item price over the user's mean viewed price; 0.0 without one."""
    return guarded_ratio(price, user_avg)


def discount_affinity(
    ev_cat: DataFrame, sessions: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Correlation of the item's discount with 'carted or purchased' over the history; 0 when
    undefined. Discounts count in hundredths of a percent, so all sums are whole numbers."""
    x = F.floor(F.col("discount_pct") * F.lit(100.0) + F.lit(0.5)).cast("long")
    acted = F.col("event_type").isin(ADD_TO_CART, PURCHASE)
    changes = ev_cat.where(F.col("discount_pct").isNotNull()).select(
        *by,
        "us",
        F.lit(1).alias("n"),
        x.alias("x"),
        (x * x).alias("xx"),
        one_if(acted).alias("y"),
        F.when(acted, x).otherwise(0).alias("xy"),
    )
    probes = sessions.select(*by, "session_seq", F.col("session_end_us").alias("us"))
    out = history_at(changes, probes, by, cuts, sums=["n", "x", "xx", "y", "xy"])
    n, sx, sxx, sy, sxy = [F.col(c).cast("double") for c in ("n", "x", "xx", "y", "xy")]
    cov = n * sxy - sx * sy
    spread = (n * sxx - sx * sx) * (n * sy - sy * sy)
    corr = F.when(spread > 0, cov / F.sqrt(F.greatest(spread, F.lit(1.0)))).otherwise(0.0)
    return out.select(*by, "session_seq", corr.alias("discount_affinity_score"))


def abandoned_cart_price(
    ev_cat: DataFrame, sessions: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Mean price of the items carted but not purchased before T.

    Loosely declared; here each (user, item) counts from its first cart add until its first purchase.
    """
    kind, us = F.col("event_type"), F.col("us")
    acts = ev_cat.where(kind.isin(ADD_TO_CART, PURCHASE) & F.col("current_price").isNotNull())
    pairs = acts.groupBy(*by, "item_id").agg(
        F.min(F.when(kind == ADD_TO_CART, us)).alias("carted"),
        F.min(F.when(kind == PURCHASE, us)).alias("bought"),
        F.max(micros(F.col("current_price"))).alias("price"),
    )
    carted, bought = F.col("carted"), F.col("bought")
    open_pairs = pairs.where(carted.isNotNull() & (bought.isNull() | (bought > carted)))

    def move(at: Column, sign: int) -> Column:
        return F.struct(
            at.alias("us"), F.lit(sign).alias("n"), (F.col("price") * sign).alias("p")
        )

    moves = F.array_compact(F.array(move(carted, 1), F.when(bought.isNotNull(), move(bought, -1))))
    changes = open_pairs.select(*by, F.explode(moves).alias("m")).select(*by, "m.us", "m.n", "m.p")
    probes = sessions.select(*by, "session_seq", F.col("session_end_us").alias("us"))
    out = history_at(changes, probes, by, cuts, sums=["n", "p"])
    mean = mean_of_micros(F.col("p"), F.col("n")).alias("cart_abandonment_price_threshold")
    return out.select(*by, "session_seq", mean)


def category_percentile(
    ev_cat: DataFrame, examples: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Percent rank of the example's category by view count, among the user's categories in history.

    The k-th view of a category brings it to level k. For an example whose own category has k views, the
    categories with k or more are those that reached level k before, and all seen are those that reached level
    1: two look-ups on the key (user, level), whatever the number of categories.
    ``examples`` has ``by``, session_seq, session_end_us, item_id, item_category.
    """
    keys = [*by, "session_seq", "item_id"]
    own = category_affinity(ev_cat, examples.select(*keys, "item_category", "session_end_us"), cuts, by).select(
        *keys, F.col("session_end_us").alias("us"), F.col("times_viewed_this_category").alias("_own")
    )
    views = ev_cat.where((F.col("event_type") == VIEW) & F.col("category").isNotNull()).select(*by, "category", "us")
    levels = running(
        cuts.add_piece(views, "us"), [*by, "category"], [F.col("us")], cuts, sums={"_level": F.lit(1)}
    ).select(*by, "us", "_level", F.lit(1).alias("_reached"))
    first = F.struct(F.lit(True).alias("all"), F.lit(1).cast("long").alias("level"))
    same = F.struct(F.lit(False).alias("all"), F.col("_own").cast("long").alias("level"))
    asked = F.array_compact(F.array(first, F.when(F.col("_own") > 0, same)))
    probes = own.select(*keys, "us", "_own", F.explode(asked).alias("_ask")).select(
        *keys, "us", "_own", F.col("_ask.all").alias("_all"), F.col("_ask.level").alias("_level")
    )
    answered = history_at(levels, probes, [*by, "_level"], cuts, sums=["_reached"])
    both = answered.groupBy(*keys).agg(
        F.max("_own").alias("_own"),
        F.max(F.when(F.col("_all"), F.col("_reached"))).alias("_seen"),
        F.max(F.when(~F.col("_all"), F.col("_reached"))).alias("_at_least"),
    )
    lower = F.col("_seen") - F.col("_at_least")
    rank = F.when(F.col("_own") > 0, guarded_ratio(lower, F.col("_seen") - 1)).otherwise(0.0)
    return both.select(*keys, rank.alias("category_affinity_percentile"))


def session_item_mix(ev_cat: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """Distinct categories and mean item price of a session, over all its events."""
    return ev_cat.groupBy(*by, "session_seq").agg(
        F.count_distinct("category").alias("unique_categories_session"),
        mean_of_micros(F.sum(micros(F.col("current_price"))), F.count("current_price")).alias(
            "avg_item_price_session"
        ),
    )


# --- item aggregates, from the train split only ---------------------------------------------------


def item_counts(train: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return train.groupBy("item_id").agg(
        F.count_if(kind == VIEW).alias("n_views"), F.count_if(kind == PURCHASE).alias("n_purchases")
    )


def item_popularity(train: DataFrame) -> DataFrame:
    """Percent rank of each item by train views."""
    return popularity_of(settle(item_counts(train).select("item_id", "n_views")))


def popularity_of(counts: DataFrame) -> DataFrame:
    """Percent rank by ``n_views`` of stored rows, one per item."""
    levels = counts.groupBy("n_views").agg(F.count(F.lit(1)).alias("n"))
    cuts = value_cuts(levels, "n_views", descending=False)
    below = running(
        cuts.add_piece(levels),
        [],
        [F.col("n_views")],
        cuts,
        sums={"_upto": F.col("n")},
    ).select("n_views", (F.col("_upto") - F.col("n")).alias("_below"))
    total = counts.count()
    ranked = join_lookup(counts, below, "n_views", "inner")
    return ranked.select(
        "item_id", guarded_ratio(F.col("_below"), F.lit(total - 1)).alias("item_popularity_score")
    )


def item_conversion(train: DataFrame) -> DataFrame:
    rate = guarded_ratio(F.col("n_purchases"), F.col("n_views")).alias("item_conversion_rate")
    return item_counts(train).select("item_id", rate)


def item_time_to_purchase(train: DataFrame, skew: SkewParams = SkewParams()) -> DataFrame:
    """Mean days from a user's first view of the item to their first later purchase of it."""
    kind = F.col("event_type")
    cuts = time_cuts(train, "user_id", "us", skew)
    views = train.where(kind == VIEW).select("user_id", "item_id", "us", (-F.col("us")).alias("neg"))
    buys = train.where(kind == PURCHASE).select("user_id", "item_id", "us")
    seen = history_at(views, buys, ["user_id", "item_id"], cuts, maxes=["neg"])
    pairs = seen.where(F.col("neg").isNotNull()).groupBy("user_id", "item_id").agg(
        (F.min("us") + F.max("neg")).alias("wait_us")
    )
    days = F.try_divide(
        F.sum("wait_us").cast("double"), F.count(F.lit(1)).cast("double") * F.lit(float(DAY_US))
    )
    return pairs.groupBy("item_id").agg(days.alias("item_avg_time_to_purchase"))


def item_cart_abandonment(train: DataFrame) -> DataFrame:
    """One minus the share of (user, item) pairs put in a cart that are ever purchased."""
    kind = F.col("event_type")
    pairs = train.groupBy("user_id", "item_id").agg(
        F.max(one_if(kind == ADD_TO_CART)).alias("carted"),
        F.max(one_if(kind == PURCHASE)).alias("bought"),
    )
    return pairs.where(F.col("carted") == 1).groupBy("item_id").agg(
        guarded_ratio(F.count_if(F.col("bought") == 0), F.count(F.lit(1))).alias(
            "item_cart_abandonment_rate"
        )
    )


def category_conversion(train: DataFrame, catalog: DataFrame) -> DataFrame:
    """Mean conversion rate of a category's items."""
    return category_means(item_conversion(train), catalog)


def category_means(rates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Mean of the items' ``item_conversion_rate`` per category."""
    with_cat = join_lookup(rates, catalog.select("item_id", "category"), "item_id", "inner")
    fixed = F.floor(F.col("item_conversion_rate") * F.lit(float(FIXED_POINT))).cast("decimal(28,0)")
    n = F.count(F.lit(1)).cast("double") * F.lit(float(FIXED_POINT))
    return with_cat.groupBy("category").agg(
        F.try_divide(F.sum(fixed).cast("double"), n).alias("category_avg_conversion_rate")
    )


def pair_counts(train: DataFrame) -> DataFrame:
    """What a user did with an item: views, purchases, cart adds and the first view."""
    kind = F.col("event_type")
    return train.groupBy("user_id", "item_id").agg(
        F.count_if(kind == VIEW).alias("n_views"),
        F.count_if(kind == PURCHASE).alias("n_purchases"),
        F.count_if(kind == ADD_TO_CART).alias("n_carts"),
        F.min(F.when(kind == VIEW, F.col("us"))).alias("first_view"),
    )


def train_item_table(train: DataFrame, catalog: DataFrame) -> DataFrame:
    """All train-only aggregates, one row per item known from train or the catalog.

    Train is read twice: for one row per user and item, which all counts come from, and for the purchases, which meet the
    first view of their user and item.
    """
    pairs = settle(pair_counts(train))
    buys = train.where(F.col("event_type") == PURCHASE).select("user_id", "item_id", "us")
    viewed = pairs.where("first_view IS NOT NULL AND n_purchases > 0").select("user_id", "item_id", "first_view")
    waits = (
        buys.join(viewed, ["user_id", "item_id"])
        .where("us > first_view")
        .groupBy("user_id", "item_id")
        .agg(F.min(F.col("us") - F.col("first_view")).alias("wait_us"))
        .groupBy("item_id")
        .agg(F.sum("wait_us").cast("double").alias("_wait"), F.count(F.lit(1)).cast("double").alias("_waits"))
    )
    carted = F.col("n_carts") > 0
    counts = pairs.groupBy("item_id").agg(
        F.sum("n_views").alias("n_views"),
        F.sum("n_purchases").alias("n_purchases"),
        F.count_if(carted).alias("_carted"),
        F.count_if(carted & (F.col("n_purchases") == 0)).alias("_left"),
    )
    items = settle(
        counts.join(waits, "item_id", "left").select(  # both sides unique on item_id
            "item_id",
            "n_views",
            guarded_ratio(F.col("n_purchases"), F.col("n_views")).alias("item_conversion_rate"),
            F.try_divide("_wait", F.col("_waits") * F.lit(float(DAY_US))).alias("item_avg_time_to_purchase"),
            F.when(F.col("_carted") > 0, guarded_ratio(F.col("_left"), F.col("_carted"))).alias("item_cart_abandonment_rate"),
        )
    )
    ranked = items.join(popularity_of(items.select("item_id", "n_views")), "item_id", "left").drop("n_views")
    by_category = join_lookup(
        catalog.select("item_id", "category"), category_means(items.select("item_id", "item_conversion_rate"), catalog), "category", computed=True
    )
    return ranked.join(by_category.drop("category"), "item_id", "full")


def with_train_aggregates(df: DataFrame, train: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left join the train-only item aggregates to rows of any split; null when unseen in train."""
    return join_lookup(df, settle(train_item_table(train, catalog)), "item_id")


def label_bought_in_days(
    cand: DataFrame, ev: DataFrame, cuts: Cuts, days: int = 30, by: Sequence[str] = USER
) -> DataFrame:
    """The item bought after T and at most ``days`` later: two inclusive look-ups per candidate."""
    keys = [*by, "item_id", "session_seq"]
    buys = ev.where(F.col("event_type") == PURCHASE).select(*by, "item_id", "us", F.lit(1).alias("n"))
    ends = F.array(F.col("session_end_us"), F.col("session_end_us") + days * DAY_US)
    probes = cand.select(*keys, F.explode(ends).alias("us"))
    seen = history_at(buys, probes, [*by, "item_id"], cuts, sums=["n"], inclusive=True)
    hits = seen.groupBy(*keys).agg((F.max("n") - F.min("n")).alias("n")).where(F.col("n") > 0)
    return flag_examples(cand, hits, keys, f"label_bought_{days}d")
