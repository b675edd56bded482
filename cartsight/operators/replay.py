"""The point-in-time features once more, by replaying events forward: an answer cannot see what has not happened yet.

Rows are dealt by history and ordered by time. A task walks through them and keeps, for one history at a time, what has
happened so far; a question is answered from that and nothing else, before the events of its own instant become history. It
shares no code with the batch features but the scalar formulas, and is what they are compared with. A history is
walked in one task: its state is counters per item and category and the events of the longest window.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.functions.columns import guarded_ratio, hours_since, minutes_between, whole_days_since
from cartsight.operators.examples import USER
from cartsight.operators.features import COUNTED, feature_columns, item_attributes, with_category
from cartsight.params import ADD_TO_CART, DAY_US, SCROLL, VIEW
from cartsight.sources.tables import settle

IN_SESSION, QUESTION, IN_HISTORY = 0, 1, 2  # what a row does, in this order at one instant


class Window:
    """Events of the last days before the question: counts by type, and items viewed."""

    def __init__(self, days: int) -> None:
        self.span, self.events = days * DAY_US, deque()
        self.counts, self.viewed = Counter(), Counter()

    def add(self, us: int, kind: str, item: object) -> None:
        self.events.append((us, kind, item))
        self.counts[kind] += 1
        if kind == VIEW and item is not None:
            self.viewed[item] += 1

    def forget(self, now: int) -> None:
        while self.events and self.events[0][0] < now - self.span:
            _, kind, item = self.events.popleft()
            self.counts[kind] -= 1
            if kind == VIEW and item is not None:
                self.viewed[item] -= 1
                if not self.viewed[item]:
                    del self.viewed[item]


class History:
    """What one history knows so far."""

    def __init__(self, days: Sequence[int]) -> None:
        self.first: int | None = None
        self.last: dict[str, int] = {}
        self.windows = {w: Window(w) for w in days}
        self.items, self.categories = Counter(), Counter()
        self.session: tuple | None = None

    def happens(self, us: int, kind: str, item: object, seq: int) -> None:
        """The session so far, the present event included."""
        if self.session is None or self.session[0] != seq:
            self.session = seq, us, Counter(), set(), {}
        _, _, counts, items, viewed = self.session
        counts[kind] += 1
        if item is not None:
            items.add(item)
        if kind == VIEW:
            viewed[item] = True

    def becomes_history(self, us: int, kind: str, item: object, category: object) -> None:
        self.first = us if self.first is None else self.first
        self.last[kind] = us
        for w in self.windows.values():
            w.add(us, kind, item)
        if item is not None:
            self.items[kind, item] += 1
        if kind == VIEW and category is not None:
            self.categories[category] += 1


def replayed_features(
    ev: DataFrame,
    catalog: DataFrame,
    sessions: DataFrame,
    by: Sequence[str] = USER,
    windows_days: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    """``by``, session_seq, item_id and all features of every item viewed in the sessions asked for.

    ``sessions`` has ``by``, session_seq and session_end_us; a session is asked about at its last event.
    """
    days = sorted({*windows_days, 7, 30})
    keys = [*by, "session_seq"]
    seen = with_category(ev, catalog).select(*keys, "us", "event_type", "item_id", "category")
    events = seen.withColumn("_does", F.explode(F.array(F.lit(IN_SESSION), F.lit(IN_HISTORY))))
    asked = sessions.select(*keys, F.col("session_end_us").alias("us")).withColumn("_does", F.lit(QUESTION))
    rows = events.unionByName(asked, allowMissingColumns=True)
    # the category of each viewed item, to be asked for
    known = catalog.select("item_id", F.col("category").alias("_category"))
    made = T.StructType(
        [
            *(seen.schema[c] for c in keys),
            T.StructField("us", T.LongType()),
            seen.schema["item_id"],
            T.StructField("first_us", T.LongType()),
            *(T.StructField(f"last_{one}", T.LongType()) for _, _, one in COUNTED),
            *(T.StructField(f"{many}_{w}", T.LongType()) for w in days for _, many, _ in COUNTED),
            *(T.StructField(f"items_{w}", T.LongType()) for w in days),
            T.StructField("start_us", T.LongType()),
            *(T.StructField(f"{n}_session", T.LongType()) for n in ("items_viewed", "items_scrolled", "items_carted", "unique_items")),
            *(T.StructField(f"times_{n}_this_item", T.LongType()) for n in ("viewed", "scrolled", "carted")),
            T.StructField("categories", T.MapType(seen.schema["category"].dataType, T.LongType())),
        ]
    )
    arrow = to_arrow_schema(made)
    width = len(by)

    def answers(h: History, key: tuple, seq: int, now: int) -> Iterator[tuple]:
        if h.session is None or h.session[0] != seq:
            return
        for w in h.windows.values():
            w.forget(now)
        _, start, counts, items, viewed = h.session
        shared = (
            h.first,
            *(h.last.get(t) for t, _, _ in COUNTED),
            *(h.windows[w].counts[t] for w in days for t, _, _ in COUNTED),
            *(len(h.windows[w].viewed) for w in days),
            start,
            counts[VIEW],
            counts[SCROLL],
            counts[ADD_TO_CART],
            len(items),
        )
        for item in viewed:
            own = (h.items[VIEW, item], h.items[SCROLL, item], h.items[ADD_TO_CART, item])
            yield (*key, seq, now, item, *shared, *own, list(h.categories.items()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, history = None, History(days)
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, (seq, us, kind, item, category, does) = row[:width], row[width:]
                if key != at:
                    at, history = key, History(days)
                if does == IN_SESSION:
                    history.happens(us, kind, item, seq)
                elif does == QUESTION:
                    out += answers(history, key, seq, us)
                else:
                    history.becomes_history(us, kind, item, category)
            columns = list(zip(*out)) if out else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    ordered = rows.select(*keys, "us", "event_type", "item_id", "category", "_does").repartition(*by)
    # stored, so that no later step (such as looking for hot items) walks again
    told = settle(ordered.sortWithinPartitions(*by, "us", "_does").mapInArrow(walk, made))
    now = F.col("us")
    full = item_attributes(told.join(known, "item_id", "left"), catalog)
    recent = [hours_since(F.col(f"last_{one}"), now).alias(f"hours_since_last_{one}") for _, _, one in COUNTED]
    counts = [F.col(f"{many}_{w}").alias(f"{many}_count_{w}d") for w in windows_days for _, many, _ in COUNTED]
    values = full.select(
        *keys,
        "item_id",
        *recent,
        whole_days_since(F.col("first_us"), now).alias("days_since_registration"),
        *counts,
        *[F.col(f"items_{w}").alias(f"unique_items_viewed_{w}d") for w in windows_days],
        guarded_ratio(F.col("scrolls_7"), F.col("views_7")).alias("view_to_scroll_ratio_7d"),
        guarded_ratio(F.col("cart_adds_7"), F.col("scrolls_7")).alias("scroll_to_cart_ratio_7d"),
        guarded_ratio(F.col("purchases_30"), F.col("cart_adds_30")).alias("cart_to_purchase_ratio_30d"),
        minutes_between(F.col("start_us"), now).alias("session_length_minutes"),
        *[f"{n}_session" for n in ("items_viewed", "items_scrolled", "items_carted", "unique_items")],
        *[f"times_{n}_this_item" for n in ("viewed", "scrolled", "carted")],
        F.coalesce(F.try_element_at("categories", F.col("_category")), F.lit(0)).alias("times_viewed_this_category"),
        *[f"item_{n}" for n in ("current_price", "base_price", "discount_pct", "has_discount", "category")],
    )
    return values.select(*keys, "item_id", *feature_columns(windows_days))


def replay_differences(
    features: DataFrame,
    ev: DataFrame,
    catalog: DataFrame,
    by: Sequence[str] = USER,
    windows_days: Sequence[int] = (1, 7, 30),
    replayed: DataFrame | None = None,
) -> DataFrame:
    """Rows of a feature table that a forward replay answers otherwise, and the replay's answers to them. Must be empty.

    ``features`` has ``by``, session_seq, item_id, session_end_us and all features, for whole sessions. ``replayed`` may give
    the stored answers to the same sessions (``replay_of``), where several tables are compared with them.
    """
    columns = [*by, "session_seq", "item_id", *feature_columns(windows_days)]
    if replayed is None:
        replayed = replay_of(features, ev, catalog, by, windows_days)
    types = {f.name: f.dataType for f in replayed.schema}
    given = features.select(*(F.col(c).cast(types[c]).alias(c) for c in columns))
    # how often a row is given, less how often it is answered: both ways in one pass
    both = given.withColumn("_n", F.lit(1)).unionByName(replayed.select(*columns).withColumn("_n", F.lit(-1)))
    more = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return more.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n")))).drop("_n")


def replay_of(
    features: DataFrame, ev: DataFrame, catalog: DataFrame, by: Sequence[str] = USER, windows_days: Sequence[int] = (1, 7, 30)
) -> DataFrame:
    """The replay's answers to all sessions of a feature table. Of the catalog only the items of the events are looked up."""
    asked = features.select(*by, "session_seq", "session_end_us").distinct()
    known = settle(catalog.join(ev.select("item_id").distinct(), "item_id", "left_semi"))
    return replayed_features(ev, known, asked, by, windows_days)
