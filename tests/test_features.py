"""Features against a plain per-example computation, with and without cut users."""

import pytest
from conftest import CUT_ALL, PLAIN, SMALL, as_set, frame
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartsight.operators import declared as D
from cartsight.operators import features as FE
from cartsight.operators import sessions as S
from cartsight.operators.examples import training_examples
from cartsight.operators.skew import SkewParams, join_lookup, time_cuts
from cartsight.operators.split import ends_of, temporal_split
from cartsight.params import DAY_US, SessionParams
from cartsight.sources import fixtures
from cartsight.sources.tables import settle

BOTH = pytest.mark.parametrize("skew", [PLAIN, CUT_ALL], ids=["plain", "cut"])


def expected_features(events, catalog):
    """One pass per example over its user's events, straight from the definitions."""
    out = {}
    users = {}
    for e in events:
        users.setdefault(e["user_id"], []).append(e)
    for user, mine in users.items():
        seqs = sorted({e["session_seq"] for e in mine})
        for i, seq in enumerate(seqs[:-3] if len(seqs) > 3 else []):
            session = [e for e in mine if e["session_seq"] == seq]
            t = max(e["us"] for e in session)
            past = [e for e in mine if e["us"] < t]
            soon = [e for e in mine if e["session_seq"] in seqs[i + 1 : i + 4]]

            def count(kind, days=None, rows=past):
                return sum(
                    e["event_type"] == kind and (days is None or e["us"] >= t - days * DAY_US)
                    for e in rows
                )

            for item in {e["item_id"] for e in session if e["event_type"] == "view"}:
                category, base, pct, price = catalog[item]
                f = {"label": int(any(e["event_type"] == "purchase" and e["item_id"] == item for e in soon))}
                for kind in ("view", "scroll", "add_to_cart", "purchase"):
                    last = [e["us"] for e in past if e["event_type"] == kind]
                    f[f"hours_since_last_{kind}"] = (t - max(last)) / 3.6e9 if last else 9999.0
                f["days_since_registration"] = (t - min(e["us"] for e in past)) // DAY_US if past else 0
                for w in (1, 7, 30):
                    f[f"views_count_{w}d"] = count("view", w)
                    f[f"scrolls_count_{w}d"] = count("scroll", w)
                    f[f"cart_adds_count_{w}d"] = count("add_to_cart", w)
                    f[f"purchases_count_{w}d"] = count("purchase", w)
                    f[f"unique_items_viewed_{w}d"] = len(
                        {e["item_id"] for e in past if e["event_type"] == "view" and e["us"] >= t - w * DAY_US}
                    )
                ratio = lambda a, b: a / b if b else 0.0
                f["view_to_scroll_ratio_7d"] = ratio(count("scroll", 7), count("view", 7))
                f["scroll_to_cart_ratio_7d"] = ratio(count("add_to_cart", 7), count("scroll", 7))
                f["cart_to_purchase_ratio_30d"] = ratio(count("purchase", 30), count("add_to_cart", 30))
                f["session_length_minutes"] = (t - min(e["us"] for e in session)) / 6e7
                f["items_viewed_session"] = count("view", rows=session)
                f["items_scrolled_session"] = count("scroll", rows=session)
                f["items_carted_session"] = count("add_to_cart", rows=session)
                f["unique_items_session"] = len({e["item_id"] for e in session})
                this = [e for e in past if e["item_id"] == item]
                f["times_viewed_this_item"] = count("view", rows=this)
                f["times_scrolled_this_item"] = count("scroll", rows=this)
                f["times_carted_this_item"] = count("add_to_cart", rows=this)
                alike = [e for e in past if catalog[e["item_id"]][0] == category]
                f["times_viewed_this_category"] = count("view", rows=alike)
                f["item_current_price"], f["item_base_price"] = price, base
                f["item_discount_pct"], f["item_has_discount"] = pct, int(pct > 0)
                f["item_category"] = category
                out[(user, item, seq)] = f
    return out


def check(features, expected):
    rows = [r.asDict() for r in features.collect()]
    assert len(rows) == len(expected)
    for r in rows:
        want = expected[(r["user_id"], r["item_id"], r["session_seq"])]
        got = {k: r[k] for k in want}
        assert got == want, (r["user_id"], r["item_id"], r["session_seq"])


def catalog_of(catalog):
    return {
        r["item_id"]: (r["category"], r["base_price"], r["discount_pct"], r["current_price"])
        for r in catalog.collect()
    }


@BOTH
@pytest.mark.parametrize("gap", [480, 1440])
def test_all_features_match_the_definitions(spark, skew, gap):
    ev = settle(S.sessions_by_gap(fixtures.clickstream(spark, SMALL), SessionParams(gap), skew))
    catalog = fixtures.catalog(spark, SMALL)
    assert len(FE.feature_columns()) == 37
    assert time_cuts(ev, "user_id", "us", skew).active == (skew is CUT_ALL)
    features = FE.build_features(ev, catalog, skew=skew)
    check(features, expected_features([r.asDict() for r in ev.collect()], catalog_of(catalog)))


@BOTH
def test_each_split_sees_only_its_own_events(spark, skew):
    clicks = fixtures.clickstream(spark, SMALL)
    ev = S.sessions_by_gap(clicks, SessionParams(480), skew)
    split = settle(temporal_split(ev, ends_of(clicks)))
    catalog = fixtures.catalog(spark, SMALL)
    features = settle(FE.build_features(split, catalog, ("split", "user_id"), skew=skew))
    for name in ("train", "val", "test"):
        events = [r.asDict() for r in split.where(F.col("split") == name).collect()]
        part = features.where(F.col("split") == name)
        check(part, expected_features(events, catalog_of(catalog)))


def tiny_catalog(spark, items=(1, 2, 3)):
    return spark.createDataFrame(
        [(i, "Books" if i < 3 else "Clothing", 10.0 * i, 0.0, 10.0 * i) for i in items],
        "item_id long, category string, base_price double, discount_pct double, current_price double",
    )


TAIL = [(20_000 + 1440 * i, "scroll", 9) for i in range(3)]


@BOTH
def test_ties_at_the_session_end_are_not_history(spark, skew):
    ev = settle(S.sessions_by_gap(frame(spark, [(0, "view", 1), (5, "view", 1), (5, "scroll", 1), *TAIL])))
    row = FE.build_features(ev, tiny_catalog(spark, (1, 2, 3, 9)), skew=skew).first()
    assert row["times_viewed_this_item"] == 1 and row["views_count_1d"] == 1
    assert row["scrolls_count_1d"] == 0 and row["items_scrolled_session"] == 1
    assert row["hours_since_last_scroll"] == 9999.0
    assert row["hours_since_last_view"] == 5 / 60


@BOTH
def test_window_start_is_inclusive(spark, skew):
    week = 7 * 1440
    rows = [(0, "view", 1), (week, "view", 2), *TAIL]
    ev = settle(S.sessions_by_gap(frame(spark, rows)))
    out = FE.build_features(ev, tiny_catalog(spark, (1, 2, 3, 9)), skew=skew)
    second = out.where("session_seq = 2").first()
    assert second["views_count_7d"] == 1 and second["unique_items_viewed_7d"] == 1
    assert second["views_count_1d"] == 0 and second["unique_items_viewed_1d"] == 0
    assert second["view_to_scroll_ratio_7d"] == 0.0
    assert second["hours_since_last_purchase"] == 9999.0
    assert second["days_since_registration"] == 7


@BOTH
def test_repeat_views_count_once(spark, skew):
    rows = [(0, "view", 1), (700, "view", 1), (1440, "view", 1), (2879, "view", 2), *TAIL]
    ev = settle(S.sessions_by_gap(frame(spark, rows)))
    out = FE.build_features(ev, tiny_catalog(spark, (1, 2, 3, 9)), skew=skew)
    fourth = out.where("session_seq = 4").first()
    assert fourth["unique_items_viewed_1d"] == 1 and fourth["unique_items_viewed_7d"] == 1
    assert fourth["views_count_7d"] == 3


def test_label_looks_three_sessions_ahead(spark):
    day = 1440
    rows = [(0, "view", 1), (day, "view", 2), (2 * day, "scroll", 3), (3 * day, "purchase", 1)]
    rows += [(4 * day, "purchase", 2), (5 * day, "scroll", 3)]
    ev = S.sessions_by_gap(frame(spark, rows))
    got = as_set(training_examples(ev), "session_seq", "item_id", "label")
    assert got == [(1, 1, 1), (2, 2, 1)]
    later = S.sessions_by_gap(frame(spark, [*rows[:3], (3 * day, "scroll", 1), (4 * day, "purchase", 1)]))
    assert as_set(training_examples(later), "session_seq", "item_id", "label") == [(1, 1, 0), (2, 2, 0)]


def test_unknown_item_fails_loudly(spark):
    ev = settle(S.sessions_by_gap(frame(spark, [(0, "view", 77), *TAIL])))
    with pytest.raises(PySparkException, match="Item not in catalog: 77"):
        FE.build_features(ev, tiny_catalog(spark)).collect()


def test_lookup_join_beyond_the_broadcast_bound(spark):
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).alias("k")
    )
    lookup = spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    skew = SkewParams(share=0.1, min_rows=10)
    for how in ("left", "inner"):
        want = as_set(big.join(lookup, "k", how).na.fill(-1), "id", "k", "v")
        split = join_lookup(big, lookup, "k", how, max_broadcast_rows=10, skew=skew)
        assert as_set(split.na.fill(-1), "id", "k", "v") == want
        assert as_set(join_lookup(big, lookup, "k", how).na.fill(-1), "id", "k", "v") == want


def test_declared_features_hold_for_cut_users(spark):
    ev = settle(
        D.with_item_details(
            S.sessions_by_gap(fixtures.clickstream(spark, SMALL), SessionParams(480)),
            fixtures.catalog(spark, SMALL),
        )
    )
    sessions = S.session_table(ev).select("user_id", "session_seq", F.col("end_us").alias("session_end_us"))
    examples = FE.item_attributes(training_examples(ev), fixtures.catalog(spark, SMALL))
    cuts = [time_cuts(ev, "user_id", "us", s) for s in (PLAIN, CUT_ALL)]
    for fn in (
        D.unique_categories_viewed,
        D.time_per_item,
        D.price_levels,
        D.discount_affinity,
        D.abandoned_cart_price,
    ):
        plain, cut = [fn(ev, sessions, c) for c in cuts]
        assert as_set(plain, *plain.columns) == as_set(cut, *plain.columns), fn.__name__
    plain, cut = [D.bounce_rate(ev, c) for c in cuts]
    assert as_set(plain, *plain.columns) == as_set(cut, *plain.columns)
    plain, cut = [D.category_percentile(ev, examples, c) for c in cuts]
    assert as_set(plain, *plain.columns) == as_set(cut, *plain.columns)
    plain, cut = [D.item_time_to_purchase(ev, s) for s in (PLAIN, CUT_ALL)]
    assert as_set(plain, *plain.columns) == as_set(cut, *plain.columns)


def test_category_percentile_counts_levels(spark):
    ev = settle(
        D.with_item_details(
            S.sessions_by_gap(fixtures.clickstream(spark, SMALL), SessionParams(480)),
            fixtures.catalog(spark, SMALL),
        )
    )
    examples = FE.item_attributes(training_examples(ev), fixtures.catalog(spark, SMALL))
    views = [r for r in ev.where("event_type = 'view' AND category IS NOT NULL").collect()]
    want = []
    for x in examples.collect():
        seen = {}
        for v in views:
            if v.user_id == x.user_id and v.us < x.session_end_us:
                seen[v.category] = seen.get(v.category, 0) + 1
        own = seen.get(x.item_category, 0)
        lower = sum(0 < n < own for n in seen.values())
        want.append((x.user_id, x.session_seq, x.item_id, lower / (len(seen) - 1) if own and len(seen) > 1 else 0.0))
    for skew in (PLAIN, CUT_ALL):
        cuts = time_cuts(ev, "user_id", "us", skew)
        got = D.category_percentile(ev, examples, cuts)
        assert as_set(got, "user_id", "session_seq", "item_id", "category_affinity_percentile") == sorted(want)
    assert any(0 < r[-1] < 1 for r in want)


def test_catalog_is_cut_to_the_wanted_items(spark):
    from cartsight.operators.features import first_match

    rows = [(i % 50, f"c{i}", float(i)) for i in range(100)]
    catalog = spark.createDataFrame(rows, "item_id long, category string, base_price double")
    items = spark.createDataFrame([(3,), (7,), (999,), (None,)], "item_id long")
    assert sorted(map(tuple, first_match(catalog, "base_price", items).collect())) == [(3, "c3", 3.0), (7, "c7", 7.0)]
    assert first_match(catalog, "base_price").count() == 50


def test_history_shuffles_narrow_rows(spark):
    """Expressions over carried columns are computed behind the exchange, with the same answers."""
    from cartsight.operators.history import history_at
    from cartsight.operators.skew import NO_CUTS

    acts = spark.createDataFrame([(1, 10, 0), (1, 20, 1), (1, 30, 0), (2, 5, 1)], "user_id long, us long, _act int")
    probes = spark.createDataFrame([(1, 30), (1, 31), (2, 5)], "user_id long, us long")
    sums = {f"n{k}": F.when(F.col("_act") == k, 1) for k in (0, 1)}
    out = history_at(acts, probes, ["user_id"], NO_CUTS, sums=sums, maxes={"last": F.when(F.col("_act") == 0, F.col("us"))}, carried=["_act"])
    assert as_set(out, "user_id", "us", "n0", "n1", "last") == [(1, 30, 1, 1, 10), (1, 31, 2, 1, 30), (2, 5, 0, 0, None)]
