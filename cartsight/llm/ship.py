"""Preparing a session: the package goes to the executors, and batches of long texts are kept small."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()
# Rows in a batch where the session has Spark's default: texts of 100 KB and more make batches of the default size
# take hundreds of MB in the executor and in its Python workers.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
}


def ship(spark: SparkSession) -> None:
    """Small batches; and once per application the package's source files as a zip, which Spark sends to every executor."""
    for key, (default, small) in BATCHES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, small)
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix=f"{package.name}-")), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(target)
    _SENT.add(context.applicationId)
