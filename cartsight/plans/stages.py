"""Stages that run again only when something they depend on has changed.

A stage's result lies in a folder of its own version. A table of finished versions says which one counts: a row is appended
when a version is complete, so readers see the old one until then, and a run that fails leaves no trace but an unused folder.
The row holds a fingerprint of the input files (path, length, time of change), of the parameters and of the schema
of the result; a stage whose fingerprint has a row is not run.

Tables by day are refreshed by day: the days whose rows have changed are written again, the others are not touched.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, is_dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.sources.tables import new_folder, read_table, write_table

FINISHED = "stage string, fingerprint string, path string, finished timestamp"


def files_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the names, lengths and times of change of all files below some paths; none is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    row = listed.select("path", "length", "modificationTime").agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("s")).first()
    return f"{row['n']}:{row['s']}"


def fingerprint(spark: SparkSession, inputs: Sequence[str], params: object, schema: str) -> str:
    """Digest of what a stage's result depends on: its input files, its parameters and the schema of its result."""
    given = asdict(params) if is_dataclass(params) else params
    text = json.dumps([files_fingerprint(spark, inputs), given, schema], sort_keys=True, default=str)
    return spark.range(1).select(F.sha2(F.lit(text), 256)).first()[0]


class Stages:
    """Stored stages below one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    @property
    def finished(self) -> DataFrame:
        """A row for each finished version, the latest of a stage last."""
        path = f"{self.folder}/finished"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        return self.spark.read.schema(FINISHED).parquet(path) if there else self.spark.createDataFrame([], FINISHED)

    def latest(self, name: str) -> tuple[str, str] | None:
        """Fingerprint and path of the version that counts."""
        row = self.finished.where(F.col("stage") == name).orderBy(F.desc("finished"), F.desc("path")).first()
        return (row["fingerprint"], row["path"]) if row else None

    def run(
        self,
        name: str,
        inputs: Sequence[str],
        params: object,
        build: Callable[[], DataFrame],
        partition_by: Sequence[str] = (),
    ) -> tuple[DataFrame, bool]:
        """The stage's table, and whether it had to be written. ``build`` gives the plan; without a change it is not executed."""
        plan = build()
        mark = fingerprint(self.spark, inputs, params, plan.schema.json())
        last = self.latest(name)
        if last and last[0] == mark:
            return read_table(self.spark, last[1], plan.schema), False
        path = f"{self.folder}/{new_folder(self.spark, name).rsplit('/', 1)[-1]}"
        write_table(plan, path, partition_by=partition_by)
        row = self.spark.range(1).select(F.lit(name), F.lit(mark), F.lit(path), F.current_timestamp()).toDF(*_names(FINISHED))
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/finished")
        return read_table(self.spark, path, plan.schema), True


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def day_marks(df: DataFrame, day: str) -> DataFrame:
    """Rows and a digest of all columns for each value of ``day``, whatever the order of rows."""
    columns = [F.col(c) for c in sorted(df.columns)]
    one: Column = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(one).alias("digest"))


def refresh_days(df: DataFrame, path: str, day: str, build: Callable[[DataFrame], DataFrame] | None = None) -> Mapping[object, str]:
    """Write a table partitioned by ``day``, only the days whose source rows are new or have changed; gives what was done per day.

    ``build`` makes the table's rows of a day from the source rows of that day alone. Days that the source no longer has stay.
    The marks of the source lie beside the table and are written last: a run that fails in between does the days again.
    """
    spark = df.sparkSession
    now = day_marks(df, day)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/marks")
    fresh = not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if fresh:
        before = now.where("false")
    else:
        before = spark.read.parquet(f"{path}/marks").select(*now.columns)
    old = before.withColumnsRenamed({"n_rows": "n_before", "digest": "digest_before"})
    same = (F.col("n_rows") == F.col("n_before")) & (F.col("digest") == F.col("digest_before"))
    joined = now.join(old, day, "left").where(~F.coalesce(same, F.lit(False)))
    changed = joined.select(day, F.col("n_before").isNotNull().alias("known")).collect()  # one row per day
    if not changed:
        return {}
    days = [r[day] for r in changed]
    rows = df.where(F.col(day).isin(days))
    out = rows if build is None else build(rows)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(f"{path}/rows")
    # marks of the days written now, in place of their earlier ones
    marks = now.where(F.col(day).isin(days)).withColumn("of_day", F.col(day).cast("string"))
    marks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("of_day").parquet(f"{path}/marks")
    return {r[day]: "changed" if r["known"] else "new" for r in changed}
