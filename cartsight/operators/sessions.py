"""Session assignment (by inactivity gap, by high-intent boundary) and session-level tables.

Event tables carry ``us`` (microseconds) beside or instead of a timestamp, and ``event_id`` as the
tie-breaker within one instant. Sessionizers add:

``session_seq``       running number of the session within its user, from 1
``session_id``        ``<user>_session_0001``
``session_start_us``  instant of the session's first event

Events without a user belong to no session: they are kept, with nulls in these columns, and take part in no
window, so that their number does not matter.

The start is carried along the same ordered pass as the number, so a later split by session start
needs no join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartsight.functions.columns import guarded_ratio, minutes_between, one_if, session_name
from cartsight.operators.ordered import neighbours, running
from cartsight.operators.skew import PIECE, Cuts, time_cuts
from cartsight.params import (
    ADD_TO_CART,
    MINUTE_US,
    PURCHASE,
    SCROLL,
    SECOND_US,
    VIEW,
    SessionParams,
    SkewParams,
)
from cartsight.sources.tables import require_columns

_ADDED = ("session_id", "session_seq", "session_start_us")


def _ready(events: DataFrame) -> DataFrame:
    """Drop whatever session columns came in: they are replaced."""
    require_columns(events, ("user_id", "us", "event_type", "item_id", "event_id"))
    return events.drop(*_ADDED)


def _order() -> list[Column]:
    return [F.col("us"), F.col("event_id")]


def _number_sessions(
    pieces: DataFrame, cuts: Cuts, carried: Column, starts: Callable[[Column, Column], Column]
) -> DataFrame:
    """Number the sessions of each user and carry their start along, in one ordered pass.

    ``starts(previous, us)`` tells from the previous row's ``carried`` value whether a row at ``us``
    starts a session; the first row of a user always does. With cut users the first row of a piece
    is decided afterwards, from one summary row per piece.
    """
    parts = ["user_id", *cuts.columns]
    ordered = Window.partitionBy(*parts).orderBy(*_order())
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flagged = pieces.withColumn("_carried", carried).withColumn(
        "_new", F.coalesce(starts(F.lag("_carried").over(ordered), F.col("us")), F.lit(False))
    )
    new_us = F.when(F.col("_new"), F.col("us"))
    local = flagged.withColumns(
        {
            "session_seq": F.sum(one_if(F.col("_new"))).over(so_far),
            "session_start_us": F.max(new_us).over(so_far),
            "_first_us": F.min("us").over(so_far),
        }
    )
    if not cuts.active:
        carry_seq, carry_start = F.lit(1), F.col("_first_us")
    else:
        local = local.join(_piece_carry(flagged, parts, starts), parts, "left")
        carry_seq, carry_start = F.col("_carry_seq"), F.col("_carry_start")
    return local.select(
        *[c for c in pieces.columns if c not in cuts.columns],
        (F.col("session_seq") + carry_seq).cast("long").alias("session_seq"),
        F.coalesce("session_start_us", carry_start).alias("session_start_us"),
    )


def _piece_carry(
    flagged: DataFrame, parts: list[str], starts: Callable[[Column, Column], Column]
) -> DataFrame:
    """Per piece: sessions started up to its first row, and the start of the session it opens in."""
    pieces = flagged.groupBy(*parts).agg(
        F.min("us").alias("_first"),
        F.max_by("_carried", F.struct(*_order())).alias("_last"),
        F.sum(one_if(F.col("_new"))).alias("_n"),
        F.max(F.when(F.col("_new"), F.col("us"))).alias("_last_start"),
    )
    by_piece = Window.partitionBy("user_id").orderBy(PIECE)
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.coalesce(starts(F.lag("_last").over(by_piece), F.col("_first")), F.lit(True))
    decided = pieces.withColumn("_head", head)
    return decided.select(
        *parts,
        (
            F.sum(one_if(F.col("_head"))).over(upto) + F.coalesce(F.sum("_n").over(before), F.lit(0))
        ).alias("_carry_seq"),
        F.greatest(
            F.max(F.when(F.col("_head"), F.col("_first"))).over(upto),
            F.max("_last_start").over(before),
        ).alias("_carry_start"),
    )


def _named(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("session_id", session_name(F.col("user_id"), F.col("session_seq"), kind))


def _with_anonymous(done: DataFrame, events: DataFrame) -> DataFrame:
    """The rows without a user, added with nulls in the new columns."""
    return done.unionByName(events.where(F.col("user_id").isNull()), allowMissingColumns=True)


def gap_to_previous(
    events: DataFrame, skew: SkewParams = SkewParams(), cuts: Cuts | None = None
) -> DataFrame:
    """Add ``gap_us``, the time since the user's previous event (null on the first, and without a user)."""
    named = events.where(F.col("user_id").isNotNull())
    cuts = cuts or time_cuts(named, "user_id", "us", skew)
    pieces = cuts.add_piece(named, "us")
    out = neighbours(pieces, ["user_id"], _order(), "us", cuts, previous="_prev")
    gaps = out.withColumn("gap_us", F.col("us") - F.col("_prev")).drop("_prev", PIECE)
    return _with_anonymous(gaps, events)


def sessions_by_gap(
    events: DataFrame,
    params: SessionParams = SessionParams(),
    skew: SkewParams = SkewParams(),
    cuts: Cuts | None = None,
) -> DataFrame:
    """A new session starts at a user's first event and after a gap above the threshold.

    A gap of exactly the threshold stays inside the session.
    """
    events = _ready(events)
    named = events.where(F.col("user_id").isNotNull())
    cuts = cuts or time_cuts(named, "user_id", "us", skew)
    threshold = params.inactivity_minutes * MINUTE_US
    numbered = _number_sessions(
        cuts.add_piece(named, "us"),
        cuts,
        carried=F.col("us"),
        starts=lambda previous, us: us - previous > F.lit(threshold),
    )
    return _with_anonymous(_named(numbered, "session"), events)


def boundary_flags(events: DataFrame, params: SessionParams = SessionParams()) -> DataFrame:
    return events.withColumn("is_boundary", F.col("event_type").isin(*params.boundary_events))


def sessions_by_intent(
    events: DataFrame,
    params: SessionParams = SessionParams(),
    skew: SkewParams = SkewParams(),
    cuts: Cuts | None = None,
) -> DataFrame:
    """A boundary event closes its session; the row after it opens the next one."""
    events = _ready(events)
    named = events.where(F.col("user_id").isNotNull())
    cuts = cuts or time_cuts(named, "user_id", "us", skew)
    numbered = _number_sessions(
        cuts.add_piece(named, "us"),
        cuts,
        carried=F.col("event_type").isin(*params.boundary_events),
        starts=lambda previous, us: previous,
    )
    return _with_anonymous(_named(numbered, "intent_session"), events)


def shifted_boundary(events: DataFrame, params: SessionParams = SessionParams(), skew: SkewParams = SkewParams()) -> DataFrame:
    """Add ``starts``: the row before was a boundary event, or there is none. Null without a user."""
    out = sessions_by_intent(events, params, skew)
    named = out.where(F.col("user_id").isNotNull())
    cuts = time_cuts(named, "user_id", "us", skew)
    order = [F.col("session_seq"), *_order()]
    before = neighbours(cuts.add_piece(named, "us"), ["user_id"], order, "session_seq", cuts, previous="_before")
    started = F.col("_before").isNull() | (F.col("_before") < F.col("session_seq"))
    return _with_anonymous(before.withColumn("starts", started).drop("_before", PIECE), out)


def session_table(sessionized: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """One row per session: bounds, size, and event counts. All aggregates combine map side."""
    kind = F.col("event_type")
    return sessionized.groupBy(*by, "session_seq").agg(
        F.min("session_id").alias("session_id"),
        F.min("us").alias("start_us"),
        F.max("us").alias("end_us"),
        F.count(F.lit(1)).alias("n_events"),
        F.max(one_if(kind == PURCHASE)).alias("has_purchase"),
        F.count_if(kind == VIEW).alias("n_views"),
        F.count_if(kind == SCROLL).alias("n_scrolls"),
        F.count_if(kind == ADD_TO_CART).alias("n_carts"),
    )


def session_info(sessionized: DataFrame) -> DataFrame:
    """Start, end and user of every session."""
    return sessionized.groupBy("session_id").agg(
        F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.min("user_id").alias("user_id")
    )


def session_stats(sessionized: DataFrame) -> DataFrame:
    """One row: totals, mean size and duration, purchase sessions, conversion."""
    total_us = F.sum(F.col("end_us") - F.col("start_us"))
    n = F.count(F.lit(1))
    return session_table(sessionized).agg(
        F.coalesce(F.sum("n_events"), F.lit(0)).alias("total_events"),
        n.alias("total_sessions"),
        guarded_ratio(F.sum("n_events"), n).alias("avg_events_per_session"),
        F.coalesce(
            F.try_divide(total_us.cast("double"), (n * F.lit(MINUTE_US)).cast("double")), F.lit(0.0)
        ).alias("avg_session_duration_minutes"),
        F.coalesce(F.sum("has_purchase"), F.lit(0)).alias("sessions_with_purchase"),
        guarded_ratio(F.sum("has_purchase"), n).alias("conversion_rate"),
    )


def session_ordinals(sessionized: DataFrame, skew: SkewParams = SkewParams()) -> DataFrame:
    """Position of each session within its user, counted over the sessions present."""
    sessions = session_table(sessionized).select("user_id", "session_seq", "start_us")
    cuts = time_cuts(sessions, "user_id", "session_seq", skew)
    return running(
        cuts.add_piece(sessions, "session_seq"),
        ["user_id"],
        [F.col("session_seq")],
        cuts,
        sums={"ordinal": F.lit(1)},
    ).drop(PIECE)


def lookahead_span(sessions: DataFrame, horizon: int, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Sessions followed by at least ``horizon`` sessions of the same user.

    Session numbers are dense, so session s qualifies exactly when session s + horizon exists:
    an equi semi join on a unique key, with no per-user window.
    """
    later = sessions.select(*by, (F.col("session_seq") - horizon).alias("session_seq"))
    return sessions.join(later, [*by, "session_seq"], "left_semi")


def session_violations(sessionized: DataFrame) -> DataFrame:
    """One row of violation counts: ids shared by users, and sessions out of order per user.

    A session cannot be empty here, since sessions are derived from events.
    """
    by_id = sessionized.groupBy("session_id").agg(
        F.min("user_id").alias("lo"), F.max("user_id").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    ids = by_id.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.count_if(F.col("n") < 1).alias("empty_sessions"),
        F.count_if(F.col("lo") != F.col("hi")).alias("shared_ids"),
    )
    table = session_table(sessionized).select("user_id", "session_seq", "start_us", "end_us")
    following = table.select(
        "user_id", (F.col("session_seq") - 1).alias("session_seq"), F.col("start_us").alias("next_us")
    )
    order = table.join(following, ["user_id", "session_seq"]).agg(
        F.count_if(F.col("next_us") < F.col("end_us")).alias("overlapping_sessions")
    )
    # two one-row tables
    return ids.withColumn("_k", F.lit(1)).join(order.withColumn("_k", F.lit(1)), "_k").drop("_k")


def duration_bounds(sessionized: DataFrame, params: SessionParams = SessionParams()) -> DataFrame:
    """Sessions inside, below and above the declared duration bounds."""
    length = F.col("end_us") - F.col("start_us")
    low = params.min_duration_seconds * SECOND_US
    high = params.max_duration_seconds * SECOND_US
    return session_table(sessionized).agg(
        F.count_if(length < low).alias("too_short"),
        F.count_if(length > high).alias("too_long"),
        F.count_if((length >= low) & (length <= high)).alias("within_bounds"),
    )


def session_minutes(sessions: DataFrame) -> Column:
    return minutes_between(F.col("start_us"), F.col("end_us"))
