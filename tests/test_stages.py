"""Stages that are skipped without a change, and tables that are refreshed by day."""

from pyspark.sql import functions as F

from cartsight.params import SessionParams
from cartsight.plans.stages import Stages, refresh_days
from cartsight.sources.tables import new_folder


def events(spark, days=(1, 2, 3)):
    rows = [(d, u, 10 * d + u) for d in days for u in range(4)]
    return spark.createDataFrame(rows, "day int, user_id long, value long")


def test_a_second_run_does_no_work(spark):
    source, folder = new_folder(spark, "source"), new_folder(spark, "stages")
    events(spark).write.parquet(source)

    def build():
        return spark.read.parquet(source).groupBy("user_id").agg(F.sum("value").alias("total"))

    stages = Stages(spark, folder)
    first, wrote = stages.run("totals", [source], SessionParams(), build)
    again, wrote_again = stages.run("totals", [source], SessionParams(), build)
    assert wrote and not wrote_again and sorted(first.collect()) == sorted(again.collect())
    assert stages.finished.count() == 1
    # other parameters, another schema, another file
    assert stages.run("totals", [source], SessionParams(inactivity_minutes=5), build)[1]
    assert stages.run("totals", [source], SessionParams(inactivity_minutes=5), lambda: build().withColumn("more", F.lit(1)))[1]
    events(spark, (4,)).write.mode("append").parquet(source)
    last, wrote = stages.run("totals", [source], SessionParams(), build)
    assert wrote and last.agg(F.sum("total")).first()[0] == sum(10 * d + u for d in (1, 2, 3, 4) for u in range(4))


def test_a_failed_run_leaves_the_old_version(spark):
    source, folder = new_folder(spark, "source"), new_folder(spark, "stages")
    events(spark).write.parquet(source)
    stages = Stages(spark, folder)
    good, _ = stages.run("rows", [source], 1, lambda: spark.read.parquet(source))
    broken = lambda: spark.read.parquet(source).withColumn("value", F.raise_error(F.lit("broken")).cast("long"))
    try:
        stages.run("rows", [source], 2, broken)
        raise AssertionError("did not fail")
    except Exception as e:
        assert "broken" in str(e)
    kept, wrote = stages.run("rows", [source], 1, lambda: spark.read.parquet(source))
    assert not wrote and kept.count() == good.count() == 12


def test_only_changed_days_are_written(spark):
    path = new_folder(spark, "days")

    def files():
        rows = spark.read.parquet(f"{path}/rows").select("day", F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {(r.day, r.f) for r in rows}

    double = lambda df: df.withColumn("value", F.col("value") * 2)
    assert refresh_days(events(spark), path, "day", double) == {1: "new", 2: "new", 3: "new"}
    before = files()
    assert refresh_days(events(spark).orderBy(F.desc("value")), path, "day", double) == {} and files() == before
    later = events(spark, (1, 2, 3, 4)).withColumn("value", F.when(F.col("day") == 2, 7).otherwise(F.col("value")))
    assert refresh_days(later, path, "day", double) == {2: "changed", 4: "new"}
    after = files()
    assert {x for x in before if x[0] in (1, 3)} <= after and not {x for x in before if x[0] == 2} & after
    got = spark.read.parquet(f"{path}/rows").select("day", "user_id", "value")
    assert got.exceptAll(double(later)).count() == 0 and got.count() == 16
    assert refresh_days(later, path, "day", double) == {}
