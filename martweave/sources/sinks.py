"""Writers: full rebuild, incremental append, audit log, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def rebuild(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Full rebuild of a stored table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rebuild_table(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None on the first run; any other trouble with it is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newer_rows(source: DataFrame, target: DataFrame | None, mark: str) -> DataFrame:
    """Rows beyond the target's high-water mark; all rows on the first run.

    Rows on or before the mark are not taken, also when they are new.
    """
    if target is None:
        return source
    top = target.agg(F.max(mark).alias("m")).first()["m"]
    return source if top is None else source.filter(F.col(mark) > F.lit(top))


def append_newer(source: DataFrame, path: str, mark: str) -> DataFrame:
    """Incremental load by high-water mark.

    With the mark known as a constant the filter reaches the source scan.
    """
    spark = source.sparkSession
    newer_rows(source, stored_or_none(spark, path), mark).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def json_arrays(df: DataFrame, path: str, key: str, rows_per_file: int = 50_000) -> None:
    """Writes rows as JSON files that hold one array each, some `rows_per_file` rows in a file.

    An array cannot be split by its readers, so its size is bounded here: the number of files
    follows the number of rows, and the hash of `key`, which should be unique, picks the file.
    `df` is read twice, once to count it.
    """
    files = max(1, -(-df.count() // rows_per_file))
    file = F.pmod(F.xxhash64(key), F.lit(files)).alias("file")
    arrays = df.groupBy(file).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.write.partitionBy("file").text(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def expire(df: DataFrame, stamp, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) by age; rows without a readable time are kept."""
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    old = F.coalesce(stamp < limit, F.lit(False))
    return df.filter(~old), df.filter(old)


def row_counts(spark: SparkSession, named: dict[str, object]) -> DataFrame:
    """(table, rows, error) per entry; a table that cannot be read gives its error and does not stop the rest.

    Entries are DataFrames or functions giving one.  Each is counted by a job of its own, so a
    table that fails while it is read fails alone.
    """
    found = []
    for name, source in named.items():
        try:
            df = source() if callable(source) else source
            found.append((name, df.count(), None))
        except Exception as problem:  # noqa: BLE001
            found.append((name, None, str(problem)))
    return spark.createDataFrame(found, "table string, rows bigint, error string")
