import pytest
from conftest import MEDIUM, as_set, frame
from pyspark.sql import functions as F

from cartsight.operators import split as P
from cartsight.operators.sessions import sessions_by_gap
from cartsight.params import SessionParams
from cartsight.sources import fixtures

DAY = 1440


def test_days_are_truncated_products():
    assert P.split_days(30) == (21, 4, 5)
    assert P.split_days(90) == (62, 13, 15)


def test_ends_are_midnights():
    ends = P.split_ends("2024-01-01", 30)
    assert ends == P.SplitEnds.from_dates("2024-01-22", "2024-01-26", "2024-01-31")


def test_each_end_belongs_to_the_earlier_split(spark):
    ends = P.SplitEnds(1000, 2000, 3000)
    rows = spark.createDataFrame([(v,) for v in (1000, 1001, 2000, 2001, 3000, 3001)], "s long")
    named = rows.select("s", P.split_name(F.col("s"), ends).alias("n"))
    assert [r["n"] for r in named.orderBy("s").collect()] == ["train", "val", "val", "test", "test", None]


def test_sessions_go_whole_by_their_start(spark):
    ev = sessions_by_gap(frame(spark, [(0, "view"), (20, "view"), (40, "view"), (200, "view")]))
    ends = P.SplitEnds(10 * 60_000_000, 300 * 60_000_000, 400 * 60_000_000)
    split = P.temporal_split(ev, ends)
    assert [r[1] for r in as_set(split, "event_id", "split")] == ["train", "train", "train", "val"]
    same = P.temporal_split(ev.drop("session_start_us"), ends)
    assert as_set(same, "event_id", "split") == as_set(split, "event_id", "split")
    P.assert_no_leakage(split, ends)


def test_late_sessions_are_left_out_and_empty_train_fails(spark):
    ev = sessions_by_gap(frame(spark, [(100, "view")]))
    ends = P.SplitEnds(0, 1, 2)
    split = P.temporal_split(ev, ends)
    assert split.count() == 0
    with pytest.raises(AssertionError, match="empty_train"):
        P.assert_no_leakage(split, ends)


def test_wrong_split_is_reported(spark):
    ev = sessions_by_gap(frame(spark, [(0, "view"), (100, "view")]))
    wrong = ev.withColumn("split", F.lit("train"))
    with pytest.raises(AssertionError, match="late_train"):
        P.assert_no_leakage(wrong, P.SplitEnds(0, 1, 2))


@pytest.mark.parametrize(
    "gap, expected",
    [
        (30, {"train": (6996, 6680), "val": (1343, 1286), "test": (1661, 1583)}),
        (480, {"train": (7050, 3333), "val": (1348, 636), "test": (1602, 797)}),
    ],
)
def test_published_counts(spark, gap, expected):
    ev = fixtures.clickstream(spark, MEDIUM)
    split = P.temporal_split(sessions_by_gap(ev, SessionParams(inactivity_minutes=gap)), P.ends_of(ev))
    got = {r["split"]: (r["n_events"], r["n_sessions"]) for r in P.split_summary(split).collect()}
    assert got == expected
