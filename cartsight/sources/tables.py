"""Table schemas, checked reads, and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICKSTREAM = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)
ITEM_CATALOG = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("base_price", T.DoubleType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("persona", T.StringType()),
        T.StructField("sessions_per_week", T.IntegerType()),
        T.StructField("registration_date", T.TimestampType()),
    ]
)

SESSIONIZER_COLUMNS = ("user_id", "timestamp", "event_type", "item_id")


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every missing column."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. Give a schema for declared tables so that no file is opened to infer it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite a stored table: snappy Parquet by default, CSV with a header on request."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    elif fmt == "csv":
        writer = writer.option("header", True)
    else:
        raise ValueError(f"Unknown table format: {fmt}")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def with_micros(df: DataFrame, ts: str = "timestamp", name: str = "us") -> DataFrame:
    """Add the instant as integer microseconds since the epoch (UTC), for either timestamp type."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    else:
        micros = F.unix_micros(F.col(ts))
    return df.withColumn(name, micros)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored intermediate tables: the cluster's checkpoint folder.

    Only a local session without one gets a folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cartsight-"))
    return sc.getCheckpointDir().rstrip("/")


_RUNS: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, or inside the run's own if one is open."""
    base = _RUNS[-1] if _RUNS else shared_folder(spark)
    return f"{base}/cartsight-{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """While open, all stored intermediates go to one new folder, which is removed at the end.

    Write results that are to stay elsewhere before the end.
    """
    folder = new_folder(spark, "run")
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Store a table once in the shared folder and continue from the stored rows.

    Used where a table feeds several branches of a plan. Each branch then scans only its own
    columns, and losing an executor costs no recomputation of what came before.
    """
    path = new_folder(df.sparkSession, "table")
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema)
