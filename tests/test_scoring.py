import pytest
from conftest import as_set
from pyspark.sql import functions as F

from cartsight.functions.columns import confidence_band, guarded_ratio
from cartsight.operators import quality as Q
from cartsight.operators import scoring as K

ROW = {"user_id": "u-17", "item_id": "i-204", "item_price": 24.5, "item_base_price": 35.0,
       "item_discount_pct": 30.0, "item_category": "Garden"}


def request(spark, **change):
    return spark.createDataFrame([{**ROW, **change}])


def test_bands_are_strict(spark):
    df = spark.createDataFrame([(p,) for p in (0.29, 0.3, 0.4, 0.5, 0.6, 0.7, 0.71)], "p double")
    got = [r[0] for r in df.select(confidence_band(F.col("p"))).collect()]
    assert got == ["high", "medium", "low", "low", "low", "medium", "high"]


def test_minimal_row_is_valid_with_defaults(spark):
    row = K.validate(K.with_defaults(request(spark))).first()
    assert row["valid"] and row["reject_reason"] is None
    assert row["view_count_7d"] == 0 and row["session_item_count"] == 1
    assert row["cart_to_purchase_ratio"] == 0.0 and row["days_since_last_view"] is None


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"item_price": -10.0}, "item_price must be > 0"),
        ({"item_discount_pct": 101.0}, "item_discount_pct must be in [0, 100]"),
        ({"view_count_7d": -1}, "view_count_7d must be >= 0"),
        ({"cart_to_purchase_ratio": 1.5}, "cart_to_purchase_ratio must be in [0, 1]"),
        ({"session_item_count": 0}, "session_item_count must be >= 1"),
        ({"days_since_last_cart": -0.5}, "days_since_last_cart must be >= 0"),
    ],
)
def test_broken_rules_are_named(spark, change, reason):
    row = K.validate(K.with_defaults(request(spark, **change))).first()
    assert not row["valid"] and row["reject_reason"] == reason


def test_batch_and_threshold_limits():
    for n in (0, 1001):
        with pytest.raises(ValueError):
            K.check_batch_size(n)
    K.check_batch_size(1000)
    with pytest.raises(ValueError):
        K.check_threshold(1.5)


def test_rows_get_decision_band_and_version(spark):
    df = spark.createDataFrame([("u", "i", 0.5), ("u", "j", 0.49)], "user_id string, item_id string, p double")
    out = K.score_rows(df, F.col("p"), "v7")
    assert as_set(out, "item_id", "prediction", "confidence", "model_version") == [
        ("i", 1, "low", "v7"), ("j", 0, "low", "v7")]


def test_alignment_fills_what_is_missing(spark):
    wanted = {"b": None, "a": None, **K.category_dummies(["x", "y"], "cat")}
    df = spark.createDataFrame([(1, 2, "z"), (2, None, "x")], "id int, a int, cat string")
    got = K.align(df, wanted, ["id"])
    assert got.columns == ["id", "b", "a", "category_x", "category_y"]
    assert as_set(got, *got.columns) == [(1, 0.0, 2.0, 0.0, 0.0), (2, 0.0, 0.0, 1.0, 0.0)]


def test_sweep(spark):
    df = spark.createDataFrame([(s,) for s in (0.3, 0.5, 0.6, 0.9)], "score double")
    assert as_set(K.threshold_sweep(df), "threshold", "n_rows", "n_positive") == [
        (0.3, 4, 4), (0.5, 4, 3), (0.7, 4, 1)]


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_gates(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    with pytest.raises(AssertionError, match=r"\['b'\]"):
        Q.assert_null_gate(df)
    Q.assert_null_gate(df.select("a"))
    odd = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double")
    assert Q.non_finite_counts(odd, ["x"]).first()["n_non_finite"] == 2
    with pytest.raises(AssertionError, match="Schemas differ"):
        Q.assert_same_schema(df, odd)


def test_drift_compares_with_train(spark):
    rows = [("train", float(v)) for v in (0, 1, 2)] + [("val", 1.0), ("test", 50.0)]
    df = spark.createDataFrame(rows, "split string, x double")
    got = dict(as_set(Q.distribution_drift(df, ["x"]), "split", "drifted"))
    assert got == {"train": False, "val": False, "test": True}
