"""Preparation, training, evaluation and storage of models with Spark ML."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.operators.features import feature_columns
from cartsight.operators.ranking import area_metrics, precision_at
from cartsight.operators.ranking import best_threshold as find_threshold
from cartsight.params import ID_COLUMNS, LABEL, ModelParams, ScoreParams
from cartsight.plans import boosting
from cartsight.sources.tables import new_folder, settle

CATEGORY = "item_category"
ROWS_PER_TASK = 50_000  # rows of a partition while trees are grown
WEIGHT = "_weight"
KEYS = ("user_id", "item_id", "session_seq")  # of an example


def numeric_columns(columns: Sequence[str] | None = None) -> list[str]:
    return [c for c in (columns or feature_columns()) if c != CATEGORY]


def zero_missing(features: DataFrame) -> DataFrame:
    """Missing numeric features become 0 before training."""
    present = [c for c in numeric_columns() if c in features.columns]
    return features.na.fill(0, present)


def target_and_features(features: DataFrame) -> DataFrame:
    """The label and the model inputs, without identifiers."""
    return features.drop(*ID_COLUMNS, "session_seq", "session_end_us", "split")


def scaling_stats(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation that standardisation uses, one row per column."""
    wide = features.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{i}").alias("mean"), F.col(f"s_{i}").alias("std"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def preparation(n_train: int, columns: Sequence[str] | None = None) -> list:
    """Standardised numerics plus one-hot category, as ``features``.

    Spark scales by the sample deviation; the factor turns that into the population deviation.
    A category not seen in training encodes to all zeros.
    """
    numeric = numeric_columns(columns)
    factor = math.sqrt(n_train / (n_train - 1)) if n_train > 1 else 1.0
    return [
        StringIndexer(
            inputCol=CATEGORY,
            outputCol="_cat",
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=["_cat"], outputCols=["_cat_hot"], dropLast=True),
        VectorAssembler(inputCols=numeric, outputCol="_num"),
        StandardScaler(inputCol="_num", outputCol="_sample", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_sample",
            outputCol="_standard",
            scalingVec=Vectors.dense([factor] * len(numeric)),
        ),
        VectorAssembler(inputCols=["_standard", "_cat_hot"], outputCol="features"),
    ]


def class_counts(train: DataFrame) -> dict[int, int]:
    return {int(r[LABEL]): r["count"] for r in train.groupBy(LABEL).count().collect()}


def balanced_weights(counts: dict[int, int]) -> Column:
    """n / (2 * n_class): both classes weigh the same in total."""
    n = sum(counts.values())
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    return F.when(F.col(LABEL) == 1, n / (2.0 * pos) if pos else 1.0).otherwise(
        n / (2.0 * neg) if neg else 1.0
    )


def undersample(
    train: DataFrame, majority_share: float, seed: int = 42, keys: Sequence[str] = ("user_id", "item_id", "session_seq")
) -> DataFrame:
    """Class rebalancing by a part of the negatives; an alternative to class weights.

    A hash of the seed and the keys decides, so the same rows stay however often and wherever it runs.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10_000
    return train.where((F.col(LABEL) == 1) | (place < round(majority_share * 10_000)))


def linear_slope(model: PipelineModel, train: DataFrame, params: ModelParams = ModelParams()) -> float:
    """Largest partial derivative of the fitted linear model's loss, per unit of total weight: 0 at the optimum."""
    counts = class_counts(train)
    n = sum(counts.values())
    rows = model.transform(zero_missing(train).withColumn(WEIGHT, balanced_weights(counts)))
    error = (vector_to_array("probability")[1] - F.col(LABEL)) * F.col(WEIGHT)
    linear = model.stages[-1]
    # a summary takes no negative weights, so the errors of either sign are summed apart
    x = rows.select(error.alias("e"), "features", WEIGHT).groupBy((F.col("e") > 0).alias("above"))
    mean = Summarizer.metrics("mean").summary(F.col("features"), F.abs("e"))
    signs = x.agg(F.sum(WEIGHT).alias("w"), F.sum("e").alias("b"), vector_to_array(mean["mean"]).alias("m")).collect()
    total = sum(r["w"] for r in signs)
    sums = [sum(r["b"] * r["m"][i] for r in signs) for i in range(linear.numFeatures)]
    ridge = 1.0 / max(n, 1)
    bias = sum(r["b"] for r in signs)
    slopes = [bias / total, *(g / total + ridge * float(linear.coefficients[i]) for i, g in enumerate(sums))]
    return max(map(abs, slopes))


def fit_linear(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Logistic regression with balanced class weights and unit inverse L2 strength."""
    train = zero_missing(train)
    counts = class_counts(train)
    n = sum(counts.values())
    weighted = train.withColumn(WEIGHT, balanced_weights(counts))
    model = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=params.max_iter,
        regParam=1.0 / max(n, 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    return Pipeline(stages=[*preparation(n), model]).fit(weighted)


def rounds_with_patience(losses: Sequence[float], patience: int) -> int:
    """Rounds up to the best loss before the first stretch of ``patience`` rounds without a better one."""
    best, at = math.inf, 0
    for i, loss in enumerate(losses, 1):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return max(at, 1)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The booster after its first rounds: their trees and weights as they were fitted."""
    if rounds >= model.getNumTrees:
        return model
    sc, java = SparkContext._active_spark_context, model._java_obj
    of = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(of.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    shorter = of.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    return model._copyValues(GBTClassificationModel(shorter))


def _booster(params: ModelParams) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxDepth=params.max_depth,
        stepSize=params.step_size,
        maxIter=params.rounds,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.feature_share),
        minInfoGain=0.0,
        seed=params.seed,
    )


def _class_weight(params: ModelParams) -> Column:
    return F.when(F.col(LABEL) == 1, params.pos_weight).otherwise(1.0)


def _keys(rows: DataFrame) -> list[str]:
    return [c for c in KEYS if c in rows.columns]


def _gathered(rows: DataFrame, n: int) -> DataFrame:
    """Stored rows in as many partitions as have work, of equal size and in a fixed order: each round of a booster is several
    jobs over all of them, and the rows that it draws follow the order."""
    parts = -(-n // ROWS_PER_TASK)
    if parts <= 1:
        return rows.coalesce(1)
    keys = _keys(rows)
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys) if keys else rows.coalesce(parts)


def _grown(
    rows: DataFrame, judged: DataFrame, params: ModelParams, first: int = 0, fit: Callable | None = None
) -> tuple[GBTClassificationModel | boosting.Boosted, list[float]]:
    """A booster and its loss on other rows after each round, grown until ``patience`` has ended or all rounds are fitted.

    Two and a half times the patience is fitted first (or ``first`` rounds, if a like booster took more), and then twice
    as many rounds each time: in all at most four times the rounds that patience asks for, however many are allowed (from
    the first fit on).
    A round depends on the seed and those before it alone, so the first trees of a longer fit are those of a shorter one.
    ``fit``, if given, goes on from the shorter one.
    """
    rounds = min(params.rounds, max(first, 5 * params.patience // 2, 1))
    model = None
    while True:
        booster = _booster(replace(params, rounds=rounds))
        model = fit(booster, rows, judged, model) if fit else booster.fit(rows)
        losses = list(model.evaluateEachIteration(judged))
        if rounds == params.rounds or len(losses) - rounds_with_patience(losses, params.patience) >= params.patience:
            return model, losses
        rounds = min(params.rounds, 2 * rounds)


def fit_boosted(
    train: DataFrame, val: DataFrame | None = None, params: ModelParams = ModelParams()
) -> PipelineModel:
    """Gradient-boosted trees with a positive-class weight.

    Rounds are fitted on train. With a validation split, its weighted loss is taken after each round, and the
    trees up to the best round are kept (found with ``patience``). Splits need no minimal gain: Spark's is a mean per row,
    for which the declared gamma, a sum over rows, has no equal.
    """
    train = zero_missing(train)
    n = train.count()
    prepared = Pipeline(stages=preparation(n)).fit(train)
    columns = (LABEL, _class_weight(params).alias(WEIGHT), "features")
    rows = _gathered(settle(prepared.transform(train).select(*_keys(train), *columns)), n)
    if val is None:
        booster = _booster(params).fit(rows)
    else:
        booster, losses = _grown(rows, settle(prepared.transform(zero_missing(val)).select(*columns)), params)
        booster = first_rounds(booster, rounds_with_patience(losses, params.patience))
    return PipelineModel(stages=[*prepared.stages, booster])


def fit_forest(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """A second tree ensemble, with balanced weights, as the declared alternative."""
    train = zero_missing(train)
    counts = class_counts(train)
    n = sum(counts.values())
    model = RandomForestClassifier(
        featuresCol="features",
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxDepth=params.max_depth,
        numTrees=params.rounds,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.feature_share),
        seed=params.seed,
    )
    prepared = Pipeline(stages=preparation(n)).fit(train)
    columns = (*_keys(train), LABEL, balanced_weights(counts).alias(WEIGHT), "features")
    rows = _gathered(settle(prepared.transform(train).select(*columns)), n)
    return PipelineModel(stages=[*prepared.stages, model.fit(rows)])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The rows plus ``score``, the probability of the positive class."""
    out = model.transform(zero_missing(features))
    scored = out.withColumn("score", vector_to_array("probability")[1])
    return scored.select(*features.columns, "score")


def evaluate(scored: DataFrame, name: str, params: ScoreParams = ScoreParams()) -> DataFrame:
    """(model, metric, value) rows: areas, precision, recall and lift at each top percent."""
    scored = settle(scored.select("user_id", "item_id", "session_seq", LABEL, "score"))
    areas = area_metrics(scored).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in ("n_examples", "n_positives", "pr_auc", "roc_auc")
                ]
            )
        )
    )
    tops = precision_at(scored, params.top_percents)
    per_top = tops.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.format_string(f"{m}_at_%d_pct", F.col("percent")).alias("metric"),
                        F.col(m).cast("double").alias("value"),
                    )
                    for m in ("precision", "positives_found", "recall", "lift")
                ]
            )
        )
    )
    return areas.unionByName(per_top).select(F.lit(name).alias("model"), "metric", "value")


GRID_POINT = ("max_depth", "step_size", "rounds", "pos_weight")


def bounded_rows(train: DataFrame, most: int, seed: int, keys: Sequence[str] = ("user_id", "item_id", "session_seq")) -> DataFrame:
    """About ``most`` labelled rows, or all if there are no more: all positives that fit, and negatives by a hash of their keys.

    For trials by hand; no registered query and no grid uses it.
    """
    counts = class_counts(train)
    total, pos = sum(counts.values()), counts.get(1, 0)
    if total <= most:
        return train
    share = {1: min(1.0, most / max(pos, 1)), 0: max(0, most - pos) / max(total - pos, 1)}
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return train.where(place < F.when(F.col(LABEL) == 1, share[1]).otherwise(share[0]))


def grid_scores(train: DataFrame, val: DataFrame, params: ModelParams = ModelParams()) -> tuple[DataFrame, DataFrame]:
    """All grid points on the temporal val split.

    Gives a row for each point (its parameters and ``n_trees``, the trees kept with patience) and the val rows scored by each
    model: model, label, score. A model is named by depth, step, weight and ``n_trees``; points that keep the same
    trees share it.

    The models of fewer rounds are the first trees of one with more, so one booster (see ``_grown``) answers for every number
    of rounds. Boosters grow side by side over one prepared, stored table of all labelled rows; val is
    judged whole. All depths and steps are grown for one weight first, and the others begin with half as many rounds
    again as that took. The trees kept do not depend on it. A booster is one task where a task holds the table
    (``boosting``), else Spark's, with a job for each level.
    """
    train = zero_missing(train)
    n, n_judged = train.count(), val.count()
    prepared = Pipeline(stages=preparation(n)).fit(train)
    rows = settle(prepared.transform(train).select(*_keys(train), LABEL, "features"))
    judged = settle(prepared.transform(zero_missing(val)).select(LABEL, "features"))
    spark = rows.sparkSession
    took: dict[tuple, int] = {}  # rounds until patience ended, by depth and step
    width = len(rows.select(vector_to_array("features").alias("x")).first()["x"])
    alone = (n + n_judged) * width <= boosting.CELLS

    def fit(booster: GBTClassifier, learnt: DataFrame, judged: DataFrame, earlier: boosting.Boosted | None) -> boosting.Boosted:
        return boosting.fit_in_task(booster, learnt, judged, _keys(learnt), params.patience, earlier)

    def one(weight: float, step: float, depth: int) -> tuple[list[tuple], DataFrame]:
        point = replace(params, max_depth=depth, step_size=step, pos_weight=weight, rounds=max(params.grid_rounds))
        weighted = [x.withColumn(WEIGHT, _class_weight(point)) for x in (rows, judged)]
        weighted = weighted if alone else [_gathered(x, n) for x in weighted]
        model, losses = _grown(*weighted, point, 3 * took.get((depth, step), 0) // 2, fit if alone else None)
        took[depth, step] = max(took.get((depth, step), 0), rounds_with_patience(losses, params.patience) + params.patience)
        found, scored = [], None
        for wanted in sorted(params.grid_rounds):
            kept = rounds_with_patience(losses[:wanted], params.patience)
            found.append((depth, step, wanted, weight, kept))
        if alone:
            name = F.concat_ws("/", *(F.lit(str(x)) for x in (depth, step, weight)), F.col("kept").cast("string"))
            out = model.scores(judged, sorted({f[-1] for f in found}))
            return found, settle(out.select(name.alias("model"), LABEL, "score"))
        for kept in sorted({f[-1] for f in found}):
            out = first_rounds(model, kept).transform(judged)
            name = F.concat_ws("/", *(F.lit(str(x)) for x in (depth, step, weight, kept)))
            part = out.select(name.alias("model"), LABEL, vector_to_array("probability")[1].alias("score"))
            scored = part if scored is None else scored.unionByName(part)
        return found, settle(scored)

    # those of small steps and many levels take longest
    fits = list(itertools.product(params.grid_pos_weight, sorted(params.grid_step_size), sorted(params.grid_max_depth, reverse=True)))
    with ThreadPoolExecutor(params.grid_parallel) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(lambda fit: one(*fit)), fits))
    points = [p for found, _ in done for p in found]
    table = spark.createDataFrame(points, "max_depth int, step_size double, rounds int, pos_weight double, n_trees int")
    name = F.concat_ws("/", *(F.col(c).cast("string") for c in ("max_depth", "step_size", "pos_weight", "n_trees")))
    scored = done[0][1]
    return table.withColumn("model", name), spark.read.schema(scored.schema).parquet(*(f for _, s in done for f in s.inputFiles()))


def tune(train: DataFrame, val: DataFrame, params: ModelParams = ModelParams()) -> DataFrame:
    """A row for each grid point with ``n_trees``, ``pr_auc`` on val, and whether it is the best: the highest average precision,
    of equal ones the first in the order of the parameters."""
    points, scored = grid_scores(train, val, params)
    areas = area_metrics(scored, ("model",)).select("model", "pr_auc")
    found = settle(points.join(areas, "model", "left").na.fill(0.0, ["pr_auc"]).drop("model"))
    best = found.orderBy(F.desc("pr_auc"), *GRID_POINT).first()
    same = [F.col(c) == F.lit(best[c]) for c in GRID_POINT]
    return found.withColumn("is_best", reduce(Column.__and__, same))


def best_point(tuned: DataFrame, params: ModelParams = ModelParams()) -> ModelParams:
    """The parameters of the best grid point."""
    best = tuned.where("is_best").first()
    return replace(params, **{c: best[c] for c in GRID_POINT})


def tuned_threshold(scored: DataFrame, params: ScoreParams = ScoreParams()) -> float:
    """The searched threshold, or the default when none reaches the target precision."""
    found = find_threshold(scored, params).first()
    return found["threshold"] if found else params.threshold


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the slots of the assembled vector."""
    labels = model.stages[0].labels
    return [*numeric_columns(), *[f"{CATEGORY}={c}" for c in labels]]


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a stored ensemble's trees: tree, node, feature (null for a leaf), threshold, gain, rows and weight."""
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["gain"]).alias("gain"),
        node["rawCount"].alias("n_rows"),
        F.get(node["impurityStats"], F.lit(0)).alias("weight"),
    )


def feature_importance(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Number of splits and share of the gain (gain times weight of the rows, over all nodes) of each input of boosted trees.

    The model's trees are stored, and their nodes aggregated as a table.
    """
    spark = train.sparkSession
    path = new_folder(spark, "trees")
    model.stages[-1].write().save(path)
    splits = tree_nodes(spark, path).where("feature IS NOT NULL")
    sums = splits.groupBy(F.col("feature").alias("_slot")).agg(
        F.sum(F.col("gain") * F.col("weight")).alias("_gain"), F.count(F.lit(1)).alias("n_splits")
    )
    total = sums.agg(F.sum("_gain")).first()[0] or 1.0
    slots = spark.createDataFrame(list(enumerate(feature_names(model))), "_slot int, feature string")
    return slots.join(F.broadcast(sums), "_slot", "left").select(  # a row for each input at most
        "feature",
        F.coalesce(F.col("_gain") / F.lit(total), F.lit(0.0)).alias("importance"),
        F.coalesce("n_splits", F.lit(0)).cast("long").alias("n_splits"),
    )


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.col("n_splits").desc(), F.col("importance").desc(), "feature").limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    """Preprocessing and model together, overwriting what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def latest_model(registry: DataFrame) -> DataFrame:
    """Path and version of the newest entry of a (version, path) registry (one row)."""
    return registry.agg(
        F.max("version").alias("version"), F.max_by("path", "version").alias("path")
    )
