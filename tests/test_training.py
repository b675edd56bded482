import random
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartsight.operators.features import feature_columns
from cartsight.operators.ranking import area_metrics
from cartsight.params import ModelParams
from cartsight.plans import training as M
from cartsight.sources.tables import new_folder

QUICK = replace(ModelParams(), rounds=5, max_depth=3, max_iter=50)


def feature_rows(spark, n, seed, categories=("Books", "Clothing")):
    """Learnable: the label follows two of the features."""
    rnd = random.Random(seed)
    names = feature_columns()
    rows = []
    for i in range(n):
        row = {c: float(rnd.randrange(10)) for c in names if c != "item_category"}
        row["item_category"] = rnd.choice(categories)
        row |= {"user_id": i, "item_id": 1, "session_seq": 1}
        row["label"] = int(row["views_count_7d"] + row["times_viewed_this_item"] > 15)
        rows.append(row)
    types = {"user_id": "long", "item_id": "long", "session_seq": "long", "label": "int", "item_category": "string"}
    columns = ["user_id", "item_id", "session_seq", "label", *names]
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)


@pytest.fixture(scope="module")
def data(spark):
    return feature_rows(spark, 400, 1).cache(), feature_rows(spark, 200, 2).cache()


def vectors(model, df):
    out = model.transform(df).select(vector_to_array("features").alias("v"))
    return [r["v"] for r in out.collect()]


def test_scaling_uses_the_population_deviation(spark, data):
    train, _ = data
    model = Pipeline(stages=M.preparation(train.count())).fit(train)
    got = vectors(model, train)
    first = [v[0] for v in got]
    n = len(first)
    assert sum(first) / n == pytest.approx(0, abs=1e-9)
    assert sum(x * x for x in first) / n == pytest.approx(1, abs=1e-9)
    assert len(got[0]) == 36 + 2


def test_unseen_category_encodes_to_zeros(spark, data):
    train, _ = data
    model = Pipeline(stages=M.preparation(train.count())).fit(train)
    other = feature_rows(spark, 3, 3, ("Garden",))
    assert all(v[36:] == [0.0, 0.0] for v in vectors(model, other))


def test_balanced_weights(spark, data):
    train, _ = data
    counts = M.class_counts(train)
    totals = train.groupBy("label").agg(F.sum(M.balanced_weights(counts)).alias("w")).collect()
    assert [r["w"] for r in totals] == [pytest.approx(200.0)] * 2


@pytest.mark.parametrize("fit", ["linear", "boosted", "forest"])
def test_models_beat_the_base_rate_and_reload(spark, data, fit):
    train, val = data
    if fit == "linear":
        model = M.fit_linear(train, QUICK)
    elif fit == "boosted":
        model = M.fit_boosted(train, val, replace(QUICK, pos_weight=10.0))
    else:
        model = M.fit_forest(train, QUICK)
    scored = M.predict(model, val)
    row = area_metrics(scored).first()
    assert row["pr_auc"] > 2 * row["n_positives"] / row["n_examples"]
    path = new_folder(spark, "model")
    M.save_model(model, path)
    again = M.predict(M.load_model(path), val)
    both = scored.select("user_id", "score").exceptAll(again.select("user_id", "score"))
    assert both.count() == 0


def test_boosting_keeps_many_trees_with_splits(spark, data):
    train, val = data
    model = M.fit_boosted(train, val, replace(ModelParams(), rounds=40, max_depth=4, pos_weight=1.0))
    trees = model.stages[-1].trees
    assert len(trees) > 10 and all(t.numNodes > 1 for t in trees)


def test_patience():
    assert M.rounds_with_patience([5, 4, 3, 4, 4, 2], 2) == 3
    assert M.rounds_with_patience([5, 4, 3, 4, 4, 2], 3) == 6
    assert M.rounds_with_patience([1, 2, 3, 4], 20) == 1


def test_missing_features_count_as_zero(spark, data):
    train, _ = data
    holes = train.withColumn("views_count_1d", F.lit(None).cast("double"))
    assert M.zero_missing(holes).agg(F.sum("views_count_1d")).first()[0] == 0.0


def test_importance_names_the_useful_features(spark, data):
    train, _ = data
    model = M.fit_boosted(train, None, replace(QUICK, pos_weight=1.0))
    top = [r["feature"] for r in M.top_features(M.feature_importance(model, train), 2).collect()]
    assert set(top) == {"views_count_7d", "times_viewed_this_item"}


def test_importance_counts_the_printed_trees(spark, data):
    """Splits as the trees print them, and Spark's own importances."""
    train, _ = data
    model = M.fit_boosted(train, None, replace(QUICK, rounds=8, pos_weight=2.0))
    trees, names = model.stages[-1], M.feature_names(model)
    printed = Counter(int(i) for t in trees.trees for i in re.findall(r"If \(feature (\d+) ", t.toDebugString))
    got = {r.feature: r for r in M.feature_importance(model, train).collect()}
    assert {n: got[n].n_splits for n in names} == {n: printed[i] for i, n in enumerate(names)}
    assert [got[n].importance for n in names] == pytest.approx(list(trees.featureImportances.toArray()))
    top = M.top_features(M.feature_importance(model, train), 3).collect()
    assert [r.n_splits for r in top] == sorted(printed.values(), reverse=True)[:3]


def test_grid_is_judged_on_validation(spark, data):
    train, val = data
    grid = replace(QUICK, grid_max_depth=(1, 3), grid_step_size=(0.1,), grid_rounds=(3, 6), grid_pos_weight=(5.0,), patience=2, subsample=1.0, feature_share=1.0)
    tuned = M.tune(train, val, grid)
    rows = {(r.max_depth, r.rounds): r for r in tuned.collect()}
    assert set(rows) == {(d, r) for d in (1, 3) for r in (3, 6)} and sum(r.is_best for r in rows.values()) == 1
    best = M.best_point(tuned, grid)
    assert best.max_depth == 3 and rows[best.max_depth, best.rounds].pr_auc == max(r.pr_auc for r in rows.values())
    # a point is what a fit of its own gives (rows are in another order there, so none are left out)
    for (depth, rounds), r in rows.items():
        alone = M.fit_boosted(train, val, replace(grid, max_depth=depth, step_size=0.1, rounds=rounds, pos_weight=5.0))
        assert alone.stages[-1].getNumTrees == r.n_trees
        assert area_metrics(M.predict(alone, val)).first()["pr_auc"] == pytest.approx(r.pr_auc)


def test_first_rounds_are_those_of_a_shorter_fit(spark, data):
    train, _ = data
    params = replace(QUICK, pos_weight=3.0)
    whole, short = (M.fit_boosted(train, None, replace(params, rounds=n)) for n in (7, 4))
    cut = PipelineModel(stages=[*whole.stages[:-1], M.first_rounds(whole.stages[-1], 4)])
    path = new_folder(spark, "model")
    M.save_model(cut, path)
    scores = [M.predict(m, train).select("user_id", "score") for m in (short, cut, M.load_model(path))]
    assert scores[0].exceptAll(scores[1]).count() == 0 and scores[1].exceptAll(scores[2]).count() == 0
    assert cut.stages[-1].getNumTrees == 4 and M.first_rounds(cut.stages[-1], 9) is cut.stages[-1]


def test_grid_rows_are_bounded(spark, data):
    train, _ = data
    n, pos = train.count(), train.where("label = 1").count()
    some = M.bounded_rows(train, 200, 42)
    assert abs(some.count() - 200) < 60 and some.where("label = 1").count() == pos < 200
    assert some.exceptAll(M.bounded_rows(train, 200, 42)).count() == 0
    assert M.bounded_rows(train, n, 42) is train


def test_the_grid_learns_from_all_rows(spark, data, monkeypatch):
    train, val = data
    many = train.crossJoin(spark.range(501).withColumnRenamed("id", "copy"))
    many = many.withColumn("session_seq", F.col("copy")).drop("copy")
    learnt = []

    def grown(rows, *rest, **named):
        learnt.append(rows.count())
        raise NotImplementedError

    monkeypatch.setattr(M, "_grown", grown)
    with pytest.raises(NotImplementedError):
        M.grid_scores(many, val, replace(QUICK, grid_max_depth=(1,), grid_step_size=(0.1,), grid_rounds=(1,), grid_pos_weight=(1.0,)))
    assert learnt == [400 * 501]


def test_latest_model_is_the_largest_version(spark):
    df = spark.createDataFrame([("v1", "a"), ("v3", "c"), ("v2", "b")], "version string, path string")
    assert tuple(M.latest_model(df).first()) == ("v3", "c")


class CountedBooster:
    """Stands in for a booster: its losses are given, and the rounds of each fit are kept."""

    def __init__(self, losses, fitted, rounds):
        self.losses, self.fitted, self.rounds = losses, fitted, rounds

    def fit(self, rows):
        self.fitted.append(self.rounds)
        return self

    def evaluateEachIteration(self, rows):  # noqa: N802
        return self.losses[: self.rounds]


@pytest.mark.parametrize("best", [1, 10, 30, 70, 170, 480])
def test_rounds_beyond_the_patience_are_not_fitted(monkeypatch, best):
    params = replace(ModelParams(), rounds=500)
    losses, fitted = [abs(i - best) / 500 for i in range(1, 501)], []
    monkeypatch.setattr(M, "_booster", lambda p: CountedBooster(losses, fitted, p.rounds))
    _, found = M._grown(None, None, params)
    needed = min(params.rounds, best + params.patience)
    assert M.rounds_with_patience(found, params.patience) == M.rounds_with_patience(losses, params.patience) == best
    assert sum(fitted) <= 4 * max(needed, 13)


def test_grid_begins_where_a_like_booster_ended(spark, data, monkeypatch):
    """The other weights begin with more rounds, as the first one's booster took them; points stay as they were."""
    train, val = data
    grid = replace(QUICK, grid_max_depth=(2,), grid_step_size=(0.2,), grid_rounds=(40,), grid_pos_weight=(1.0, 1.1, 1.2), grid_parallel=1, patience=2, subsample=1.0, feature_share=1.0)
    alone = {w: M.tune(train, val, replace(grid, grid_pos_weight=(w,))).first() for w in grid.grid_pos_weight}
    fitted, booster = [], M._booster
    monkeypatch.setattr(M, "_booster", lambda p: fitted.append((p.pos_weight, p.rounds)) or booster(p))
    tuned = {r.pos_weight: r for r in M.tune(train, val, grid).collect()}
    assert {w: (r.n_trees, r.pr_auc) for w, r in tuned.items()} == {w: (r.n_trees, pytest.approx(r.pr_auc)) for w, r in alone.items()}
    begun = {w: n for w, n in reversed(fitted)}
    assert begun[1.0] == 5 and begun[1.1] == min(40, 3 * (tuned[1.0].n_trees + 2) // 2) > 5 and begun[1.2] >= begun[1.1]


def test_training_rows_lie_in_even_partitions_in_a_fixed_order(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_TASK", 500)
    rows = [(i, i % 7, 1, i % 2) for i in range(4000)]
    table = spark.createDataFrame(rows, "user_id long, item_id long, session_seq long, label int")
    uneven = table.where("user_id < 3900").coalesce(1).unionByName(table.where("user_id >= 3900").repartition(7))

    def found(df):
        return M._gathered(df, 4000).rdd.glom().map(lambda p: [r["user_id"] for r in p]).collect()

    parts = found(uneven)
    assert len(parts) == 8 and max(map(len, parts)) < 2 * 500
    assert parts == found(table.orderBy("label"))


def test_slope_of_the_linear_model(spark, data):
    """As summed row by row."""
    train, _ = data
    model = M.fit_linear(train, replace(QUICK, max_iter=3))
    counts = M.class_counts(train)
    weight = {k: sum(counts.values()) / (2 * v) for k, v in counts.items()}
    out = model.transform(train).select("label", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).collect()
    total, linear = sum(weight[r["label"]] for r in out), model.stages[-1]
    slopes = [sum((r["p"] - r["label"]) * weight[r["label"]] for r in out) / total]
    for i, c in enumerate(linear.coefficients):
        slopes.append(sum((r["p"] - r["label"]) * weight[r["label"]] * r["x"][i] for r in out) / total + float(c) / len(out))
    assert M.linear_slope(model, train) == pytest.approx(max(map(abs, slopes)), rel=1e-9)
