"""The forward replay against the batch features, and against features that look ahead; repeated catalog rows."""

import random

import pytest
from conftest import CUT_ALL, frame
from pyspark.sql import functions as F

from cartsight.operators import features as FE
from cartsight.operators import replay as R
from cartsight.operators.sessions import sessions_by_gap
from cartsight.params import EVENT_TYPES
from cartsight.sources.tables import settle

CATALOG = "item_id long, category string, base_price double, discount_pct double, current_price double"


def catalog(spark):
    return spark.createDataFrame([(i, f"c{i % 2}" if i else None, 10.0 + i, 10.0 * (i % 2), 9.0 + i) for i in range(6)], CATALOG)


def events(spark, n=500, seed=2):
    rnd = random.Random(seed)
    rows, minute = [], {u: 0.0 for u in range(4)}
    for _ in range(n):
        user = rnd.choice([0, 0, 0, 1, 2, 3])
        minute[user] += rnd.choice([0.0, 1.0, 25.0, 300.0, 2000.0, 12000.0])
        rows.append((minute[user], rnd.choice(EVENT_TYPES), rnd.randrange(6), user))
    return settle(sessions_by_gap(frame(spark, rows)))


@pytest.mark.parametrize("cut", [False, True])
def test_batch_features_equal_the_replay(spark, cut):
    ev, items = events(spark), catalog(spark)
    features = settle(FE.build_features(ev, items, **({"skew": CUT_ALL} if cut else {})))
    assert features.count() > 50
    assert R.replay_differences(features, ev, items).count() == 0


def test_replay_notices_what_looks_ahead(spark):
    ev, items = events(spark), catalog(spark)
    features = settle(FE.build_features(ev, items))
    later = features.withColumn("views_count_1d", F.col("views_count_1d") + (F.col("user_id") == 1).cast("int"))
    wrong = features.where("user_id = 1").count()
    assert R.replay_differences(later, ev, items).count() == 2 * wrong > 0


def test_first_catalog_row_counts(spark):
    ev, items = events(spark, 200), catalog(spark).withColumn("line", F.lit(1))
    again = items.withColumns({"category": F.lit("other"), "line": F.when(F.col("item_id") % 2 == 0, 0)})
    both = items.unionByName(again)
    plain = FE.build_features(ev, items)
    got = FE.build_features(ev, both, catalog_order="line")
    assert got.count() == plain.count()
    categories = {r.item_id: r.item_category for r in got.select("item_id", "item_category").distinct().collect()}
    assert all(c == ("other" if i % 2 == 0 else f"c{i % 2}") for i, c in categories.items())
    assert {(r.item_id, r.n_rows) for r in FE.repeated_items(both).collect()} == {(i, 2) for i in range(6)}
    FE.assert_unique_items(items)
    with pytest.raises(ValueError, match="more than once: 0 .2., 1 .2."):
        FE.assert_unique_items(both)


def test_differences_count_repeated_rows_both_ways(spark):
    """A row given twice and answered once is one difference; the replay runs once, whatever is compared with it."""
    ev, items = events(spark), catalog(spark)
    features = settle(FE.build_features(ev, items))
    replayed = settle(R.replay_of(features, ev, items))
    once = features.count()
    twice = features.unionByName(features.limit(1)).unionByName(features.limit(1))
    changed = features.withColumn("views_count_7d", F.col("views_count_7d") + 1)
    for table, differ in ((features, 0), (twice, 2), (changed, 2 * once)):
        assert R.replay_differences(table, ev, items, replayed=replayed).count() == differ
