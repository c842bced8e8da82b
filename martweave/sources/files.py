"""The one place that removes stored files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes folders with all they hold; those that are not there are passed over.

    Goes through the driver's JVM, as Spark has no call for it; a remote client has none.
    """
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
