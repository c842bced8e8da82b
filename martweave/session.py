"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed partition is split even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "martweave") -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter's session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTWEAVE_DRIVER_MEMORY", "8g"))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_APPLIED = "spark.martweave.settings"


def apply_settings(spark: SparkSession) -> SparkSession:
    """Sets what the operators rely on, once per session: what the caller sets later stays."""
    if spark.conf.get(_APPLIED, None) is None:
        for key, value in RUNTIME_SETTINGS.items():
            spark.conf.set(key, value)
        spark.conf.set(_APPLIED, "done")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names.

    Where none is named a temporary folder serves, but only in local mode: a
    machine-local folder on a cluster would lose data with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="martweave-")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/martweave/{label}-{uuid.uuid4().hex}"


def pin(df, label: str = "pinned"):
    """Write `df` once and read it back, so later stages neither recompute nor reorder it."""
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
