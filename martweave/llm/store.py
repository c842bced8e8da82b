"""Tables written to the shared folder, and whole rows carried through an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import run_folder


def kept(df: DataFrame, label: str) -> DataFrame:
    """`df`, written below `spark.checkpoint.dir` and read back; cuts the lineage."""
    path = run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.kept_path = path
    return stored


def forget(*stored: DataFrame) -> None:
    """Deletes tables that `kept` wrote and that nothing will read again."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct `_doc`, so that no working column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"))


def doc_field(name: str) -> Column:
    return F.col("_doc").getField(name)


def unpacked(df: DataFrame, like: DataFrame, *added: str) -> DataFrame:
    """The columns of `like` again, and those added, which replace columns of the same name."""
    taken = {a.lower() for a in added}
    return df.select(*[doc_field(c).alias(c) for c in like.columns if c.lower() not in taken], *added)


KEYS = ("_k0", "_k1")


def row_keys(columns: list[Column]) -> list[Column]:
    """A 128-bit digest of a whole row as two columns: equal rows have equal keys."""
    return [F.xxhash64(F.lit(n), *columns).alias(key) for n, key in enumerate(KEYS)]


def one_of_equal_rows(df: DataFrame) -> DataFrame:
    """Whole rows (`_doc`) by `KEYS`, equal ones once; those of a task are combined before the shuffle."""
    rows = packed(df).select("_doc", *row_keys([doc_field(c) for c in df.columns]))
    return rows.groupBy(*KEYS).agg(F.first("_doc").alias("_doc"))
