import pytest
from conftest import CUT_ALL, MEDIUM, PLAIN, as_set, frame
from pyspark.sql import functions as F

from cartsight.functions.columns import session_name
from cartsight.operators import sessions as S
from cartsight.operators.skew import hot_keys, time_cuts
from cartsight.params import SessionParams, SkewParams
from cartsight.sources import fixtures
from cartsight.sources.tables import require_columns

BOTH = pytest.mark.parametrize("skew", [PLAIN, CUT_ALL], ids=["plain", "cut"])


@BOTH
def test_gap_of_exactly_the_threshold_stays(spark, skew):
    ev = frame(spark, [(0, "view"), (30, "view"), (61, "view")])
    out = S.sessions_by_gap(ev, skew=skew)
    assert as_set(out, "event_id", "session_id") == [
        (0, "1_session_0001"),
        (1, "1_session_0001"),
        (2, "1_session_0002"),
    ]
    assert as_set(out, "event_id", "session_start_us")[2][1] == 61 * 60_000_000


@BOTH
def test_boundary_event_closes_its_session(spark, skew):
    ev = frame(spark, [(0, "view"), (1, "add_to_cart"), (2, "view"), (500, "view")])
    out = S.sessions_by_intent(ev, skew=skew)
    assert [r[1] for r in as_set(out, "event_id", "session_seq")] == [1, 1, 2, 2]
    assert [r[1] for r in as_set(out, "event_id", "session_start_us")] == [0, 0, 120_000_000, 120_000_000]
    assert as_set(out, "session_id")[0][0] == "1_intent_session_0001"


def test_tie_order_follows_event_id(spark):
    ev = frame(spark, [(0, "purchase"), (0, "view")])
    assert [r[1] for r in as_set(S.sessions_by_intent(ev), "event_id", "session_seq")] == [1, 2]


def test_old_session_id_is_replaced(spark):
    ev = frame(spark, [(0, "view")]).withColumn("session_id", F.lit("old"))
    assert as_set(S.sessions_by_gap(ev), "session_id") == [("1_session_0001",)]


def test_long_numbers_are_not_cut(spark):
    row = spark.range(1).select(session_name(F.lit("u"), F.lit(12345))).first()
    assert row[0] == "u_session_12345"


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['event_type', 'item_id'\]"):
        require_columns(spark.createDataFrame([(1, 2)], "user_id long, timestamp long"), (
            "user_id", "timestamp", "event_type", "item_id"))


def test_cut_and_plain_agree_on_all_users(spark):
    ev = fixtures.clickstream(spark, MEDIUM)
    assert time_cuts(ev, "user_id", "us", CUT_ALL).active
    assert not time_cuts(ev, "user_id", "us", PLAIN).active
    columns = ("event_id", "session_id", "session_start_us")
    for make in (S.sessions_by_gap, S.sessions_by_intent):
        plain, cut = make(ev, skew=PLAIN), make(ev, skew=CUT_ALL)
        assert as_set(plain, *columns) == as_set(cut, *columns)
    gaps = [as_set(S.gap_to_previous(ev, s).na.fill(-1), "event_id", "gap_us") for s in (PLAIN, CUT_ALL)]
    assert gaps[0] == gaps[1]
    ordinals = [
        as_set(S.session_ordinals(S.sessions_by_gap(ev), s), "user_id", "session_seq", "ordinal")
        for s in (PLAIN, CUT_ALL)
    ]
    assert ordinals[0] == ordinals[1]
    assert all(r[1] == r[2] for r in ordinals[0])


def test_one_user_with_a_third_of_all_rows(spark):
    """The hot user is found and cut, and no piece holds a large part of the table."""
    n = 60_000
    third = F.col("id") % 3 == 0
    ev = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(third, F.lit(-1)).otherwise(F.col("id") % 5000).alias("user_id"),
        (F.col("id") * 7_000_000).alias("us"),
        F.lit("view").alias("event_type"),
        (F.col("id") % 50).alias("item_id"),
    )
    skew = SkewParams(share=0.01, min_rows=1000, coarse=16, fine=4)
    assert hot_keys(ev, "user_id", skew) == [-1]
    cuts = time_cuts(ev, "user_id", "us", skew)
    sizes = cuts.add_piece(ev, "us").groupBy("user_id", "_piece").count()
    assert sizes.agg(F.max("count")).first()[0] < n / 3 / 16
    a = S.session_stats(S.sessions_by_gap(ev, skew=skew)).first()
    b = S.session_stats(S.sessions_by_gap(ev, skew=PLAIN)).first()
    assert a == b


def test_short_histories_have_no_full_lookahead(spark):
    days = [(i * 1440, "view", 1, 7) for i in range(3)] + [(i * 1440, "view", 1, 8) for i in range(4)]
    sessions = S.session_table(S.sessions_by_gap(frame(spark, days)))
    assert as_set(S.lookahead_span(sessions, 3), "user_id", "session_seq") == [(8, 1)]


def test_published_counts(spark):
    ev = fixtures.clickstream(spark, MEDIUM)
    for gap, expected in ((30, (9549, 1955)), (480, (4766, 1618)), (1440, (1214, 817))):
        row = S.session_stats(S.sessions_by_gap(ev, SessionParams(inactivity_minutes=gap))).first()
        assert (row["total_sessions"], row["sessions_with_purchase"]) == expected
    assert S.session_table(S.sessions_by_intent(ev)).count() == 4087
