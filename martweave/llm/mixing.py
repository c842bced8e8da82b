"""Mixing sources to target weights by systematic sampling.

*Targets.*  All sources together get `share` times their words, dealt out by weight.  A source
takes at most `most` times its own size; what it cannot take is dealt out again among the rest
by weight, until no target is above.  Only one row per source takes part in this.

*Sampling.*  A document of a source is expected `target / size` times.  These expected copies
are summed in the order of the documents, one random offset per source is added, and a document
is emitted once for every integer its stretch of the sum crosses.  The order is by size, largest
first, so neighbours are alike and the words taken come near the target; all documents of a
source expect the same number of copies, so the sum before a document is its place times that
number.  Places come from one distributed sort of the whole table, so a source that holds a
third of all rows is sorted by many tasks.

The offset is a digest of seed and source and ties in the order go to the smaller id, then by
the text's hash, so reruns agree.  Nulls: a null text has size 0; a null source is a source of
its own, the last in order; documents without id are mixed like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import numbered_by_content
from .store import KEYS, doc_field, kept, one_of_equal_rows, packed, row_keys, unpacked

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
_STRETCH = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """`sources` (`size`, `weight`) with `target`."""
    total = sources.agg(F.sum("size")).first()[0] or 0
    level = None
    while True:
        # a source is full if its share at this level is no less than it can take
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= most * F.col("size")
        row = sources.agg(
            F.sum(F.when(full, most * F.col("size")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        taken, weights = row[0] or 0.0, row[1] or 0.0
        higher = (share * total - taken) / weights if weights else None
        if higher is None or higher == level:
            break
        level = higher
    target = F.lit(0.0) if level is None else F.least(F.col("weight") * F.lit(level), most * F.col("size"))
    return sources.withColumn("target", target.cast("double"))


def mix(
    docs: DataFrame,
    source_column: str = "source",
    text_column: str = "text",
    id_column: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 5,
    carry: list[str] | None = None,
) -> DataFrame:
    """`docs` (or its columns `carry`) with `size`, `source_size`, `target`, `copies` and `taken`.

    The sources in code point order, null last, have the `weights`, over and over.  Columns of
    those names are replaced.
    """
    if most < share:
        raise ValueError("most must be at least share, or the mix cannot be filled")
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    rows = packed(docs).select(
        F.struct(*[doc_field(c).alias(c) for c in wanted.columns]).alias("_doc"),
        doc_field(source_column).cast("string").alias("_source"),
        doc_field(id_column).alias("_id"),
        F.xxhash64(doc_field(text_column)).alias("_key"),
        F.coalesce(F.regexp_count(doc_field(text_column), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
    )
    if carry:
        # the range sort reads its input twice: narrow rows are written, so that words are counted once
        rows = kept(rows, "sized")
    # sorted once: by source, largest first
    order = [F.col("_source").asc_nulls_last(), F.desc("size"), F.col("_id").asc_nulls_last(), F.col("_key")]
    placed = numbered_by_content(rows, order, "_place", "mixed")
    totals = placed.groupBy("_source").agg(F.sum("size").alias("size"), F.min("_place").alias("_first"))
    numbered = numbered_by_content(kept(totals, "sources"), [F.col("_source").asc_nulls_last()], "_nth", "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = kept(
        numbered.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("_nth") - 1, F.lit(len(weights))) + 1).cast("int"))),
        "sources",
    )
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit(""))))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    targets = with_targets(weighted, share, most).select(
        F.col("_source").alias("_of"),
        F.col("size").alias("source_size"),
        "target",
        "_first",
        offset.alias("_offset"),
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias("_expected"),
    )
    before = F.col("_place") - F.col("_first")
    crossed = F.floor((before + 1) * F.col("_expected") + F.col("_offset")) - F.floor(
        before * F.col("_expected") + F.col("_offset")
    )
    joined = placed.join(targets, F.col("_source").eqNullSafe(F.col("_of"))).withColumn("copies", crossed.cast("long"))
    named = joined.withColumn("taken", F.col("copies") * F.col("size"))
    return unpacked(named, wanted, "size", "source_size", "target", "copies", "taken")


def mix_rows(
    docs: DataFrame, source_column: str = "source", text_column: str = "text", id_column: str = "doc_id", **options
) -> DataFrame:
    """`docs` as often as the mix takes them, the copies of a row numbered from 1 in `copy`.

    Only ids, sizes and sources are sorted and joined with the targets; whole rows move once.  A
    row is known by a 128-bit digest of all its columns; equal rows share the copies drawn for them.
    """
    drawn = mix(
        docs.select(
            *row_keys([F.col(f"`{c}`") for c in docs.columns]),
            F.col(f"`{source_column}`").alias("_source"),
            F.col(f"`{text_column}`").alias("_text"),
            F.col(f"`{id_column}`").alias("_id"),
        ),
        "_source",
        "_text",
        "_id",
        carry=list(KEYS),
        **options,
    )
    # equal rows as one, with how many of them are taken how often: two numbers at most, as a source expects the same of all
    times = drawn.where("copies > 0").groupBy(*KEYS, "copies").agg(F.count(F.lit(1)).alias("_times"))
    taken = one_of_equal_rows(docs).join(times, list(KEYS))
    # dealt out in stretches, so no array holds all of a row's copies
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1, F.lit(_STRETCH).cast("long")))
    stretches = taken.withColumn("_begin", begin).withColumn("_stop", F.least(F.col("_begin") + _STRETCH, "_times") - 1)
    emitted = stretches.withColumn("_nth", F.explode(F.sequence("_begin", "_stop")))
    return unpacked(emitted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))), docs, "copy")
