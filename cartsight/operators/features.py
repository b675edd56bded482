"""The point-in-time features of an example at its session end T.

History is every event of the user strictly before T within the given event table; the features of
the session itself look at the whole session. ``by`` names the columns that separate histories:
``("user_id",)``, or ``("split", "user_id")`` to build every split from its own events only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.functions.columns import (
    guarded_ratio,
    hours_since,
    minutes_between,
    one_if,
    whole_days_since,
)
from cartsight.operators.examples import USER, training_examples
from cartsight.operators.history import distinct_changes, history_at, window_probes
from cartsight.operators.sessions import lookahead_span
from cartsight.operators.skew import Cuts, join_lookup, time_cuts
from cartsight.params import (
    ADD_TO_CART,
    PURCHASE,
    SCROLL,
    VIEW,
    FeatureParams,
    SkewParams,
)
from cartsight.sources.tables import settle

# The four event types that count as history, and the names they give to columns.
COUNTED = (
    (VIEW, "views", "view"),
    (SCROLL, "scrolls", "scroll"),
    (ADD_TO_CART, "cart_adds", "add_to_cart"),
    (PURCHASE, "purchases", "purchase"),
)

EVENT_COLUMNS = ("user_id", "us", "event_type", "item_id", "session_seq", "session_id")  # of events, that features come from


def feature_columns(windows_days: Sequence[int] = (1, 7, 30)) -> list[str]:
    """All features in output order; every one is numeric except ``item_category``."""
    names = [f"hours_since_last_{one}" for _, _, one in COUNTED] + ["days_since_registration"]
    for w in windows_days:
        names += [f"{many}_count_{w}d" for _, many, _ in COUNTED] + [f"unique_items_viewed_{w}d"]
    names += ["view_to_scroll_ratio_7d", "scroll_to_cart_ratio_7d", "cart_to_purchase_ratio_30d"]
    names += ["session_length_minutes", "items_viewed_session", "items_scrolled_session"]
    names += ["items_carted_session", "unique_items_session"]
    names += ["times_viewed_this_item", "times_scrolled_this_item", "times_carted_this_item"]
    names += ["times_viewed_this_category", "item_current_price", "item_base_price"]
    names += ["item_discount_pct", "item_has_discount", "item_category"]
    return names


def session_history(
    ev: DataFrame,
    sessions: DataFrame,
    cuts: Cuts,
    by: Sequence[str] = USER,
    windows_days: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    """Recency, tenure, windowed counts, distinct viewed items and intent ratios per session.

    ``sessions`` has one row per session to answer for: ``by``, session_seq, session_end_us.
    """
    kind, us = F.col("event_type"), F.col("us")
    needed = sorted({*windows_days, 7, 30})
    # an event travels as its time and the number of its type
    number = F.coalesce(*[F.when(kind == t, F.lit(i)) for i, (t, _, _) in enumerate(COUNTED)], F.lit(len(COUNTED)))
    acts = ev.select(*by, "us", number.alias("_act"))
    views = ev.where(kind == VIEW)
    moves = distinct_changes(views, by, "item_id", windows_days, cuts, "items_")
    counts = [many for _, many, _ in COUNTED]
    distincts = [f"items_{w}" for w in windows_days]
    lasts = [f"last_{one}" for _, _, one in COUNTED] + ["neg_first"]
    keys = [*by, "session_seq"]
    act = F.col("_act")
    answered = history_at(
        acts.unionByName(moves, allowMissingColumns=True),
        window_probes(sessions.select(*keys, "session_end_us"), needed),
        by,
        cuts,
        sums={
            **{many: F.when(act == i, 1) for i, many in enumerate(counts)},
            **{c: F.col(c) for c in distincts},
        },
        maxes={
            **{f"last_{one}": F.when(act == i, us) for i, (_, _, one) in enumerate(COUNTED)},
            "neg_first": F.when(act.isNotNull(), -us),
        },
        carried=["_act", *distincts],
    )
    at_end = F.col("_tag") == 0
    per_session = answered.groupBy(*keys, "session_end_us").agg(
        *[F.max(F.when(at_end, F.col(c))).alias(c) for c in counts + distincts + lasts],
        *[
            F.max(F.when(F.col("_tag") == w, F.col(c))).alias(f"{c}_to_{w}")
            for w in needed
            for c in counts
        ],
    )
    return per_session.select(*keys, *_history_features(windows_days))


def _history_features(windows_days: Sequence[int]) -> list:
    now = F.col("session_end_us")

    def within(name: str, w: int):
        return F.col(name) - F.col(f"{name}_to_{w}")

    out = [
        hours_since(F.col(f"last_{one}"), now).alias(f"hours_since_last_{one}")
        for _, _, one in COUNTED
    ]
    out.append(whole_days_since(-F.col("neg_first"), now).alias("days_since_registration"))
    for w in windows_days:
        out += [within(many, w).alias(f"{many}_count_{w}d") for _, many, _ in COUNTED]
        out.append(F.col(f"items_{w}").alias(f"unique_items_viewed_{w}d"))
    out += [
        guarded_ratio(within("scrolls", 7), within("views", 7)).alias("view_to_scroll_ratio_7d"),
        guarded_ratio(within("cart_adds", 7), within("scrolls", 7)).alias("scroll_to_cart_ratio_7d"),
        guarded_ratio(within("purchases", 30), within("cart_adds", 30)).alias(
            "cart_to_purchase_ratio_30d"
        ),
    ]
    return out


def session_context(ev: DataFrame, by: Sequence[str] = USER) -> DataFrame:
    """End and features of the session as a whole, its last event included."""
    kind = F.col("event_type")
    return ev.groupBy(*by, "session_seq").agg(
        F.max("us").alias("session_end_us"),
        minutes_between(F.min("us"), F.max("us")).alias("session_length_minutes"),
        F.count_if(kind == VIEW).alias("items_viewed_session"),
        F.count_if(kind == SCROLL).alias("items_scrolled_session"),
        F.count_if(kind == ADD_TO_CART).alias("items_carted_session"),
        F.count_distinct("item_id").alias("unique_items_session"),
    )


def item_affinity(
    ev: DataFrame, examples: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Examples plus the user's earlier views, scrolls and cart adds of the same item."""
    kind = F.col("event_type")
    names = ["times_viewed_this_item", "times_scrolled_this_item", "times_carted_this_item"]
    acts = ev.where(kind.isin(VIEW, SCROLL, ADD_TO_CART)).select(
        *by,
        "item_id",
        "us",
        *[one_if(kind == t).alias(n) for t, n in zip((VIEW, SCROLL, ADD_TO_CART), names)],
    )
    probes = examples.withColumn("us", F.col("session_end_us"))
    return history_at(acts, probes, [*by, "item_id"], cuts, sums=names).drop("us")


def category_affinity(
    ev_cat: DataFrame, examples: DataFrame, cuts: Cuts, by: Sequence[str] = USER
) -> DataFrame:
    """Examples (with ``item_category``) plus the user's earlier views in that category.

    ``ev_cat`` is the event table with the catalog's ``category`` attached.
    """
    name = "times_viewed_this_category"
    views = ev_cat.where((F.col("event_type") == VIEW) & F.col("category").isNotNull())
    acts = views.select(*by, F.col("category").alias("item_category"), "us", F.lit(1).alias(name))
    probes = examples.withColumn("us", F.col("session_end_us"))
    return history_at(acts, probes, [*by, "item_category"], cuts, sums=[name]).drop("us")


def with_category(ev: DataFrame, catalog: DataFrame, skew: SkewParams = SkewParams()) -> DataFrame:
    """Left join of events to their item's category."""
    return join_lookup(ev, catalog.select("item_id", "category"), "item_id", skew=skew)


def repeated_items(catalog: DataFrame) -> DataFrame:
    """Items that the catalog lists more than once, with the number of rows."""
    return catalog.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def first_match(catalog: DataFrame, order: str | None = None, items: DataFrame | None = None) -> DataFrame:
    """One row per item, the first by the column ``order`` (as read, without one), nulls last.

    A repeated item would multiply the rows that are joined to it. ``_metadata`` of stored files gives a lasting order.
    ``items`` (item_id) may give the only ones that are wanted.
    """
    at = F.monotonically_increasing_id() if order is None else F.col(order)
    rest = [c for c in catalog.columns if c != "item_id"]
    placed = catalog.withColumn("_at", F.struct(at.isNull(), at, F.monotonically_increasing_id()))
    if items is not None:
        placed = placed.join(items, "item_id", "left_semi")
    first = placed.groupBy("item_id").agg(F.min_by(F.struct(*rest), "_at").alias("_first"))
    return first.select("item_id", "_first.*").select(*catalog.columns)


def assert_unique_items(catalog: DataFrame, shown: int = 10) -> None:
    """Fail loudly, naming some items, when the catalog lists items more than once."""
    wrong = repeated_items(catalog).orderBy(F.desc("n_rows"), "item_id").limit(shown).collect()
    if wrong:
        raise ValueError("Items listed more than once: " + ", ".join(f"{r['item_id']} ({r['n_rows']})" for r in wrong))


def item_attributes(
    examples: DataFrame, catalog: DataFrame, skew: SkewParams = SkewParams()
) -> DataFrame:
    """Examples plus catalog attributes; ``item_known`` tells whether the item was found."""
    attrs = catalog.select(
        "item_id",
        F.col("current_price").alias("item_current_price"),
        F.col("base_price").alias("item_base_price"),
        F.col("discount_pct").alias("item_discount_pct"),
        (F.col("discount_pct") > 0).cast("int").alias("item_has_discount"),
        F.col("category").alias("item_category"),
        F.lit(True).alias("item_known"),
    )
    joined = join_lookup(examples, attrs, "item_id", skew=skew)
    return joined.withColumn("item_known", F.coalesce(F.col("item_known"), F.lit(False)))


def require_known_items(examples: DataFrame) -> DataFrame:
    """Fail the job, not silently drop rows, when an example's item is missing from the catalog."""
    checked = F.when(F.col("item_known"), F.col("item_id")).otherwise(
        F.raise_error(
            F.concat(F.lit("Item not in catalog: "), F.col("item_id").cast("string"))
        ).cast(examples.schema["item_id"].dataType)
    )
    return examples.withColumn("item_id", checked).drop("item_known")


def build_features(
    ev: DataFrame,
    catalog: DataFrame,
    by: Sequence[str] = USER,
    params: FeatureParams = FeatureParams(),
    skew: SkewParams = SkewParams(),
    cuts: Cuts | None = None,
    catalog_order: str | None = None,
) -> DataFrame:
    """Labelled examples with all features.

    ``ev`` feeds several branches: hand in a stored or settled table. The sessions that qualify
    are stored once, since examples and histories both start from them. Of an item that the catalog lists several times
    the first row counts, by ``catalog_order`` or as read. Of a large catalog only the items of the events are looked up.
    """
    catalog = settle(first_match(catalog, catalog_order, ev.select("item_id").distinct()))
    cuts = cuts or time_cuts(ev, "user_id", "us", skew)
    sessions = settle(lookahead_span(session_context(ev, by), params.horizon_sessions, by))
    examples = training_examples(ev, by, params, sessions)
    examples = require_known_items(item_attributes(examples, catalog, skew))
    examples = item_affinity(ev, examples, cuts, by)
    examples = category_affinity(with_category(ev, catalog, skew), examples, cuts, by)
    with_views = sessions.where(F.col("items_viewed_session") > 0)
    history = session_history(ev, with_views, cuts, by, params.windows_days)
    keys = [*by, "session_seq"]
    full = examples.join(history, keys)
    return full.select(
        *[c for c in by if c != "user_id"],
        "user_id",
        "item_id",
        "session_seq",
        "session_id",
        "session_end_us",
        F.timestamp_micros("session_end_us").alias("session_end_time"),
        "label",
        *feature_columns(params.windows_days),
    )
