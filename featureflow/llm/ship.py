"""Sending this package to the executors, for functions that run in Python there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_BYTES = "67108864b"
PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark's file server, once per application; executors fetch it from there."""
    context = spark.sparkContext
    if any(f.endswith("/featureflow.zip") for f in context.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="featureflow-"), "featureflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f"{PACKAGE.name}/{f.relative_to(PACKAGE)}")
    context.addPyFile(path)


# Bytes of rows that go to Python at a time; Spark's own bound is eight times as large.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of texts hold about ``BATCH_BYTES`` bytes, unless the session has a setting of its own.

    Batches lie outside the JVM's heap, several times over on their way, for every task that runs.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
