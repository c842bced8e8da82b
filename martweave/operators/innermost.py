"""Lookup of keys in ranges that may be nested or overlap: one sweep, no join, whatever the widths.

Keys and ranges are dealt to parts by cuts of a bounded sample, a range to every part it reaches
into.  In a part the ranges are swept in order of their starts with a stack of open ones, which
gives stretches with an owner each; keys take the last stretch that starts before them.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# task code travels with the job, so workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# sampled keys per part; the driver sorts parts * SAMPLE of them or some more
SAMPLE = 20
_STARTS, _KEY, _ENDS = 0, 1, 2


def innermost(
    rows: DataFrame, ranges: DataFrame, value: str, start: str, end: str, columns: Sequence[str], parts: int | None = None
) -> DataFrame:
    """`rows` with `columns` of the closed range that holds `value`, nulls where none does.

    Of several the one that starts last is taken, of these the one that ends first, then the one
    with the smallest columns; of nested ranges that is the innermost.  Keys are whole numbers of
    64 bits or binaries of one length (see `functions.addresses`).  Ranges without start or end or
    with their end before their start hold nothing; a missing value is in no range.

    Equal keys that fill more than a part are spread over several.  A part holds the stack of
    open ranges, at most as deep as they are nested, and sorts the rest outside of memory.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sound = ranges.filter(F.col(start) <= F.col(end))
    known = rows.filter(F.col(value).isNotNull())
    cuts = _cuts(known.select(F.col(value).alias("k")).unionByName(sound.select(F.col(start).alias("k"))), parts)
    low, high = _place(cuts, bisect_left), _place(cuts, bisect_right)
    owner = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(columns)])
    reached = sound.select(F.col(start).alias("_start"), F.col(end).alias("_end"), owner.alias("_owner")).withColumn(
        "_part", F.explode(F.sequence(low("_start"), high("_end")))
    )
    in_order = reached.repartition(parts, "_part").sortWithinPartitions("_part", "_start", F.desc("_end"), F.desc("_owner"))
    kinds = dict(in_order.dtypes)
    stretches = in_order.select("_part", "_start", "_end", "_owner").mapInArrow(
        _sweep, f"_part long, _at {kinds['_start']}, _kind int, _seq long, _owner {kinds['_owner']}"
    )
    spread = low(value) + F.pmod(F.xxhash64(*known.columns), high(value) - low(value) + 1)
    keys = known.select(
        spread.alias("_part"), F.col(value).alias("_at"), F.lit(_KEY).alias("_kind"), F.lit(0).cast("bigint").alias("_seq"),
        F.struct(*[F.col(f"`{c}`").alias(f"r{n}") for n, c in enumerate(rows.columns)]).alias("_row"),
    )
    so_far = Window.partitionBy("_part").orderBy("_at", "_kind", "_seq").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.last(F.when(F.col("_kind") != _KEY, F.struct("_owner")), ignorenulls=True).over(so_far)
    found = keys.unionByName(stretches, allowMissingColumns=True).withColumn("_found", latest).filter(F.col("_kind") == _KEY)
    told = found.select(
        *[F.col(f"_row.r{n}").alias(c) for n, c in enumerate(rows.columns)],
        *[F.col(f"_found._owner.c{n}").alias(c) for n, c in enumerate(columns)],
    )
    types = dict(ranges.dtypes)
    unknown = rows.filter(F.col(value).isNull()).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return told.unionAll(unknown)


def _cuts(keys: DataFrame, parts: int) -> list:
    """Keys at which parts end, in order; a key that fills several parts is there several times."""
    n = keys.count()
    if n == 0:
        return []
    drawn = sorted(r.k for r in keys.sample(min(1.0, SAMPLE * parts / n), seed=1).collect())
    drawn = [bytes(k) if isinstance(k, bytearray) else k for k in drawn]
    return [drawn[i * len(drawn) // parts] for i in range(1, parts)] if drawn else []


def _place(cuts: list, side):
    """Number of cuts below a key (`bisect_left`) or not above it (`bisect_right`)."""
    binary = bool(cuts) and isinstance(cuts[0], bytes)
    where = "left" if side is bisect_left else "right"

    @F.pandas_udf("long")
    def place(keys: pd.Series) -> pd.Series:
        if binary:
            return pd.Series([side(cuts, bytes(k)) for k in keys], dtype="int64")
        return pd.Series(np.searchsorted(np.array(cuts, dtype=np.int64), keys.to_numpy(dtype=np.int64), where).astype(np.int64))

    def of(name: str) -> Column:
        return place(F.col(name)) if cuts else F.lit(0).cast("bigint")

    return of


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of ranges sorted by part, start, falling end and falling owner.

    The ends on the stack rise towards its bottom: a range that starts earlier and ends no later
    than another never comes to light again.
    """
    stack: list = []
    part, seq = None, 0

    def close(out: list, before) -> None:
        nonlocal seq
        while stack and (before is None or stack[-1][0] < before):
            ended, _ = stack.pop()
            out.append((part, ended, _ENDS, seq, stack[-1][1] if stack else None))
            seq += 1

    schema = None
    for batch in batches:
        out: list = []
        for p, start, end, owner in zip(*[batch.column(n).to_pylist() for n in range(4)], strict=True):
            if p != part:
                close(out, None)
                part, seq = p, 0
            close(out, start)
            while stack and stack[-1][0] <= end:
                stack.pop()
            stack.append((end, owner))
            out.append((p, start, _STARTS, seq, owner))
            seq += 1
        schema = _schema(batch)
        yield _rows(out, schema)
    if schema is not None:
        out = []
        close(out, None)
        yield _rows(out, schema)


def _schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema(
        [("_part", pa.int64()), ("_at", batch.schema.field(1).type), ("_kind", pa.int32()), ("_seq", pa.int64()), ("_owner", batch.schema.field(3).type)]
    )


def _rows(out: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
