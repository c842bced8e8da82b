"""Field-wise upsert: in a batch, and into a stored table whose buckets split as it grows.

*Stored form.*  Rows lie in buckets by the low bits of their key's hash; each bucket has a depth,
the number of bits it looks at.  A bucket that a batch could fill beyond `bucket_rows` rows is
split into as many halves as needed, and only it: the tasks of a batch follow the size of the
table, and the other buckets stay where they are.

    data/<number>/key_bucket=<depth>-<bits>/...    what batch <number> wrote
    directory/number=<number>/...                  which folder holds each bucket after it

A batch writes new folders and then the directory, which is one file: until that file is there
readers and reruns see the table before the batch, from then on the table after it.  Nothing that
a directory names is overwritten.  The directory has a row per bucket and goes through the driver,
as a list of files does.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.files import remove

# rows of a bucket; some hundred MB of orders
BUCKET_ROWS = 1_000_000
# bits of the hash that buckets may look at
MAX_DEPTH = 48
_BUCKET = "key_bucket"
_DIRECTORY = "depth int, bits bigint, written bigint, rows bigint, number bigint"


class Bucket(NamedTuple):
    """A bucket of the stored table; `written` is the batch whose folder holds its rows."""

    depth: int
    bits: int
    written: int | None
    rows: int

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.bits}"

    def halves(self, times: int) -> list[Bucket]:
        return [Bucket(self.depth + times, self.bits + (n << self.depth), None, 0) for n in range(1 << times)]


def merge_upsert(
    current: DataFrame, updates: DataFrame, key: str, order: str, present: str | None = None
) -> DataFrame:
    """`current` with `updates` applied one after the other in `order`.

    A field takes the value of the latest update that carries it; a field no update carries
    keeps its stored value.  `present` names an array column listing the fields an update
    carries (a carried null overwrites); without it a non-null value counts as carried.
    An update without order comes before all that have one.  Of updates of the same order the
    one with the greatest value of the field counts, a null being the smallest.

    The latest value per field is an aggregate with map-side combine, so a key that gets a
    third of all updates is reduced before the shuffle.
    """
    fields = [c for c in current.columns if c != key]

    def carried(field: str) -> Column:
        return F.array_contains(F.col(present), field) if present else F.col(field).isNotNull()

    def place(field: str) -> Column:
        return F.struct(F.col(order).isNotNull(), F.col(order), F.col(field))

    latest = updates.groupBy(key).agg(
        *[F.max_by(F.struct(F.col(f).alias("v")), F.when(carried(f), place(f))).alias(f) for f in fields]
    )
    joined = current.alias("c").join(latest.alias("n"), key, "full_outer")
    return joined.select(
        key,
        *[
            F.when(F.col(f"n.{f}").isNotNull(), F.col(f"n.{f}.v")).otherwise(F.col(f"c.{f}")).alias(f)
            for f in fields
        ],
    )


def directories(spark: SparkSession, path: str) -> dict[int, list[Bucket]]:
    """The buckets of the table after each batch that is still kept."""
    try:
        # the partition column is named, so that it is a number at any value
        rows = spark.read.schema(_DIRECTORY).parquet(f"{path}/directory").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    found: dict[int, list[Bucket]] = {}
    for r in rows:
        found.setdefault(r.number, []).append(Bucket(r.depth, r.bits, r.written, r.rows))
    return found


def _folder(path: str, bucket: Bucket) -> str:
    return f"{path}/data/{bucket.written}/{_BUCKET}={bucket.name}"


def _rows_of(spark: SparkSession, path: str, schema: str, buckets: Iterable[Bucket]) -> DataFrame:
    folders = [_folder(path, b) for b in buckets if b.rows]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table that `store_upsert` keeps below `path`; empty before its first batch."""
    kept = directories(spark, path)
    return _rows_of(spark, path, schema, kept[max(kept)] if kept else [])


def _placed(rows: DataFrame, key: str, buckets: list[Bucket]) -> DataFrame:
    """Rows with the name of their bucket; rows of none of the `buckets` are left out."""
    deepest = max(b.depth for b in buckets)
    named = rows.sparkSession.createDataFrame([(b.depth, b.bits, b.name) for b in buckets], f"_depth int, _bits bigint, {_BUCKET} string")
    ends = F.sequence(F.lit(0).cast("bigint"), F.expr(f"shiftleft(1L, {deepest} - _depth) - 1"))
    slots = named.select(_BUCKET, F.col("_bits").alias("_low"), "_depth", F.explode(ends).alias("_high")).select(
        _BUCKET, F.expr("_low + shiftleft(_high, _depth)").alias("_slot")
    )
    low = F.xxhash64(key).bitwiseAND(F.lit((1 << deepest) - 1))
    return rows.withColumn("_slot", low).join(slots, "_slot").drop("_slot")


def _split(bucket: Bucket, added: int, limit: int) -> list[Bucket]:
    """The bucket, or the halves it is cut into if `added` keys more could be too many for it."""
    times = 0
    while (bucket.rows + added) > limit << times and bucket.depth + times < MAX_DEPTH:
        times += 1
    return bucket.halves(times) if times else [bucket]


def store_upsert(
    updates: DataFrame,
    path: str,
    schema: str,
    key: str,
    order: str,
    present: str | None = None,
    buckets: int = 1,
    bucket_rows: int = BUCKET_ROWS,
    keep: int = 2,
) -> None:
    """Merges a batch of updates into the table stored below `path`.

    Only buckets that the batch touches are read and written anew; those it could fill beyond
    `bucket_rows` rows are split on the way.  A new table starts with `buckets` of them, rounded
    up to a power of two.  Running the last batch once more changes nothing, a batch without
    rows neither.  The last `keep` states of the table stay readable; older ones are removed.
    One writer is assumed.
    """
    spark = updates.sparkSession
    kept = directories(spark, path)
    number = max(kept, default=0)
    now = kept.get(number) or Bucket(0, 0, None, 0).halves((buckets - 1).bit_length())
    # a row per bucket; keys are counted once however often they occur
    keys = _placed(updates.select(key).distinct(), key, now)
    touched = {r[0]: r[1] for r in keys.groupBy(_BUCKET).count().collect()}
    if not touched:
        return
    old = [b for b in now if b.name in touched]
    new = [half for b in old for half in _split(b, touched[b.name], bucket_rows)]
    merged = merge_upsert(_rows_of(spark, path, schema, old), updates, key, order, present)
    written = f"{path}/data/{number + 1}"
    _placed(merged, key, new).repartition(len(new), _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(written)
    stored = spark.read.schema(f"{schema}, {_BUCKET} string").parquet(written).groupBy(_BUCKET).count()
    sizes = {r[0]: r[1] for r in stored.collect()}
    state = [b for b in now if b.name not in touched]
    state += [b._replace(written=number + 1, rows=sizes.get(b.name, 0)) for b in new]
    # one file, so the state is there as a whole or not at all
    spark.createDataFrame(state, "depth int, bits bigint, written bigint, rows bigint").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/directory/number={number + 1}")
    _expire(spark, path, {**kept, number + 1: state}, keep)


def _expire(spark: SparkSession, path: str, states: dict[int, list[Bucket]], keep: int) -> None:
    """Removes all but the last `keep` states and the folders that only they name."""
    last = sorted(states)[-keep:]
    gone = [n for n in states if n not in last]
    needed = {_folder(path, b) for n in last for b in states[n] if b.rows}
    folders = {_folder(path, b) for n in gone for b in states[n] if b.rows}
    # the states go first: none may name a folder that is no more
    remove(spark, [f"{path}/directory/number={n}" for n in gone])
    remove(spark, sorted(folders - needed))
