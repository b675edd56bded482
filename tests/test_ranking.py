import math
import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cartsight.operators import ranking as R


def scored(spark, pairs):
    rows = [(i, i % 7, 1, int(l), float(s)) for i, (s, l) in enumerate(pairs)]
    return spark.createDataFrame(rows, "user_id long, item_id long, session_seq long, label int, score double")


def average_precision(pairs):
    total = sum(l for _, l in pairs)
    out, seen, hit, before = 0.0, 0, 0, 0.0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        here = [l for v, l in pairs if v == s]
        seen, hit = seen + len(here), hit + sum(here)
        out += (hit / total - before) * hit / seen
        before = hit / total
    return out


def roc_area(pairs):
    pos = [s for s, l in pairs if l]
    neg = [s for s, l in pairs if not l]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def pairs():
    rnd = random.Random(5)
    return [(rnd.randrange(60) / 60, rnd.random() < 0.2) for _ in range(900)]


def test_areas_match_their_definitions(spark, pairs):
    row = R.area_metrics(scored(spark, pairs)).first()
    assert row["pr_auc"] == pytest.approx(average_precision(pairs), abs=1e-10)
    assert row["roc_auc"] == pytest.approx(roc_area(pairs), abs=1e-12)


def test_one_class_only(spark):
    row = R.area_metrics(scored(spark, [(0.1, 0), (0.2, 0)])).first()
    assert row["roc_auc"] is None and row["pr_auc"] == 0.0


def test_a_score_held_by_a_third_of_the_rows(spark):
    """Ties are broken by the whole order, so ranks stay exact and no task takes the tied rows."""
    df = spark.range(9000).select(
        F.col("id").alias("user_id"),
        F.lit(1).alias("item_id"),
        F.lit(1).alias("session_seq"),
        (F.col("id") % 10 == 0).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") % 100) / 100.0).alias("score"),
    )
    ranked = R.with_global_rank(df, R.by_score())
    got = [r[0] for r in ranked.orderBy("rank").select("user_id").collect()]
    want = [r[0] for r in df.orderBy(*R.by_score()).select("user_id").collect()]
    assert got == want
    assert [r[0] for r in ranked.select("rank").orderBy("rank").collect()] == list(range(1, 9001))


def test_precision_at_top_percents(spark, pairs):
    df = scored(spark, pairs)
    best = [r["label"] for r in df.orderBy(*R.by_score()).collect()]
    for r in R.precision_at(df).collect():
        k = int(len(best) * r["percent"] / 100)
        assert (r["k"], r["positives_found"]) == (k, sum(best[:k]))
        assert r["precision"] == pytest.approx(sum(best[:k]) / k)
        assert r["lift"] == pytest.approx((sum(best[:k]) / k) / (sum(best) / len(best)))


def test_k_of_zero_takes_the_whole_table(spark):
    df = scored(spark, [(i / 50, i % 5 == 0) for i in range(50)])
    row = R.precision_at(df, [1]).first()
    assert row["whole_table"] and row["k"] == 0 and row["precision"] == pytest.approx(0.2)


def test_segments_match_separate_tables(spark, pairs):
    df = scored(spark, pairs).withColumn("seg", F.col("user_id") % 3)
    per = {r["seg"]: r for r in R.area_metrics(df, ["seg"]).collect()}
    tops = as_set(R.precision_at_per_segment(df, "seg"), "seg", "percent", "k", "positives_found")
    want = []
    for s in range(3):
        own = df.where(F.col("seg") == s)
        assert per[s]["pr_auc"] == R.area_metrics(own).first()["pr_auc"]
        want += [
            (s, r["percent"], r["k"], r["positives_found"]) for r in R.precision_at(own).collect()
        ]
    assert tops == sorted(want)


def test_exact_percentiles_interpolate(spark):
    df = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "v double")
    got = dict(as_set(R.exact_percentiles(df, "v", [0, 25, 50, 99, 100]), "percent", "value"))
    assert got == {0.0: 1.0, 25.0: 1.75, 50.0: 2.5, 99.0: pytest.approx(3.97), 100.0: 4.0}
    one = spark.createDataFrame([(5.0,)], "v double")
    assert R.exact_percentiles(one, "v", [50]).first()["value"] == 5.0


def test_thresholds_are_inclusive(spark):
    df = scored(spark, [(0.3, 1), (0.5, 0), (0.7, 1), (0.0, 0)])
    rows = {r["threshold"]: r for r in R.threshold_table(df, [0.3, 0.5, 0.7, 0.9]).collect()}
    got = {t: (r["true_positives"], r["false_positives"], r["false_negatives"], r["true_negatives"]) for t, r in rows.items()}
    assert got == {0.3: (2, 1, 0, 1), 0.5: (1, 1, 1, 1), 0.7: (1, 0, 1, 2), 0.9: (0, 0, 2, 2)}
    assert rows[0.9]["precision"] == 0.0


def test_threshold_search(spark):
    df = scored(spark, [(0.9, 1), (0.6, 1), (0.4, 0), (0.2, 0)])
    best = R.best_threshold(df).first()
    assert best["recall"] == 1.0 and best["precision"] == 1.0
    assert 0.4 < best["threshold"] <= 0.6
    grid = R.threshold_grid()
    assert len(grid) == 100 and grid[0] == 0.001 and math.isclose(grid[-1], 0.999)


def test_report_and_confusion(spark):
    df = scored(spark, [(0.9, 1), (0.6, 0), (0.4, 1), (0.2, 0)])
    assert as_set(R.confusion_matrix(df), "label", "prediction", "n") == [
        (0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    rows = R.classification_report(df).collect()
    assert all((r["precision"], r["recall"], r["f1"], r["support"]) == (0.5, 0.5, 0.5, 2) for r in rows)


def test_histogram_keeps_a_score_of_one(spark):
    df = scored(spark, [(1.0, 1), (0.95, 0), (0.0, 0)])
    assert as_set(R.score_histogram(df), "bucket", "n") == [(0, 1), (9, 2)]


@pytest.mark.parametrize("sketch", [10_000, 100])
def test_percentiles_by_narrowing(spark, monkeypatch, sketch):
    """Ties of a third of the rows, infinities, negative values; several rounds where the sketch is coarse."""
    monkeypatch.setattr(R, "SKETCH", sketch)
    rnd = random.Random(3)
    values = [rnd.choice([rnd.gauss(0, 1e6), 5.0, float(rnd.randrange(20))]) for _ in range(4000)]
    values += [float("-inf"), float("inf"), -0.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    ordered = sorted(v for v in values if v is not None)
    ranks = [1, 2, 17, len(ordered) // 3, len(ordered) // 2, len(ordered) - 1, len(ordered)]
    assert R.values_at_ranks(df.where("v IS NOT NULL"), "v", ranks) == {r: ordered[r - 1] for r in ranks}
    assert R.exact_percentiles(df.where("false"), "v", [50]).collect() == []


def test_percentiles_move_no_rows(spark):
    """Only aggregates of whole partitions are exchanged."""
    df = spark.createDataFrame([(float(v % 7),) for v in range(100)], "v double")
    assert R.exact_percentiles(df, "v", [50]).first()["value"] == 3.0
    curve = R.score_curve(scored(spark, [(v / 10, v % 2) for v in range(10)]))
    assert "THEN" not in curve._jdf.queryExecution().analyzed().toString()


def test_many_distinct_scores(spark):
    """Areas over pieces of a few scores equal those of one sorted pass."""
    rnd = random.Random(4)
    rows = [(rnd.choice([rnd.random(), 0.5]), int(rnd.random() < 0.2)) for _ in range(3000)]
    got = R.area_metrics(scored(spark, rows)).first()
    up = sorted(rows, reverse=True)
    total, hits, seen, ap, at = sum(y for _, y in rows), 0, 0, 0.0, 0
    while at < len(up):
        tied = [y for s, y in up[at:] if s == up[at][0]]
        hits, seen, at = hits + sum(tied), seen + len(tied), at + len(tied)
        ap += sum(tied) / total * hits / seen
    assert got["pr_auc"] == pytest.approx(ap, abs=1e-9)
