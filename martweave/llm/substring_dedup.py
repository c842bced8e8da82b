"""Removal of long passages that an earlier document already holds.

A window is `length` consecutive words.  A word goes if any window over it also starts in a
document with a smaller id.  The steps:

1. *Prefilter.*  Every window has an anchor: the smallest hash among its `gram`-word spans.
   Equal windows have equal anchors, and one anchor serves a stretch of about `length / 2`
   windows.  A count-min sketch (`sketch.py`) counts in how many documents each anchor occurs;
   the partitions' sketches are merged and broadcast.  It only overestimates, so a window
   whose anchor is estimated to occur in one document is unique: none that repeats is lost.
2. *Anchors.*  The stretches estimated repeated are grouped exactly by anchor; those that occur
   under one id only, which a full sketch lets through, end here at the cost of a row each.
3. *Runs.*  Consecutive windows that are left form a run.  Runs with the same words are grouped
   by a 128-bit digest; all but those of the smallest id are covered whole.  What copies have
   in common so costs one row per copy, not one per window.
4. *Windows.*  A second sketch over the runs that are left drops those whose copies are all
   covered.  The other windows are grouped exactly by a 128-bit digest, and those that start in
   a smaller id too are covered.

Grouping is a minimum with map-side combination, joined back to the rows, so a passage shared
by a third of all documents is never gathered in one task.

Nulls and ties: a null text has no words.  A row without id is compared with nothing and kept
whole.  Rows of the same id do not remove each other's words.  Texts shorter than a window
stay whole.  All other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan, sketch
from .store import doc_field, forget, kept, packed, unpacked

LENGTH = 50
GRAM = 10
# bytes of text per anchor, rounded down: only the width of the sketch follows from it
_BYTES_PER_ANCHOR = 64

_RUNS = "_id long, _key long, _start int, _n int, _hi long, _lo long"
_SEGMENTS = "array<struct<_start:int,_n:int>>"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _inside(found: scan.Words, segments, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (in words of the block) and window counts of the stretches to look at."""
    if segments is None:
        start, count = found.first[:-1], np.diff(found.first) - length + 1
    else:
        offsets = np.asarray(segments.offsets)
        flat = segments.flatten()
        owner = np.repeat(np.arange(len(segments)), np.diff(offsets))
        start = found.first[:-1][owner] + np.asarray(flat.field(0))
        count = np.asarray(flat.field(1)).astype(np.int64)
    some = count > 0
    return start[some], count[some]


def _stretches(batch: pa.RecordBatch, length: int, gram: int, which: int = 0):
    """Per block: first row, bytes, words, word hashes, window starts, and each window's anchor."""
    names = batch.schema.names
    segments = batch.column(names.index("_segments")) if "_segments" in names else None
    for low, high, data, off in scan.blocks(batch.column(names.index("_text"))):
        found = scan.words(data, off, scan.BLANK_SEPARATED)
        own = None if segments is None else segments.slice(low, high - low)
        start, count = _inside(found, own, length)
        if not len(start):
            continue
        hashes = scan.word_hashes(data, found)
        anchor = scan.sliding_min(scan.Prefix(hashes).every(gram), length - gram + 1)
        wanted = np.zeros(len(anchor) + 1, np.int8)
        np.add.at(wanted, start, 1)
        np.add.at(wanted, start + count, -1)
        at = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
        yield low, data, found, hashes, at, anchor[at]


def _anchor_keys(length: int, gram: int):
    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, found, _, at, anchor in _stretches(batch, length, gram):
            text = np.searchsorted(found.first, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            anchor, text = anchor[new], text[new]
            order = np.lexsort((anchor, text))
            anchor, text = anchor[order], text[order]
            once = np.ones(len(anchor), bool)
            once[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            yield anchor[once]

    return keys


def _keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(batch.schema.names.index(n))) for n in ("_id", "_key"))


def _anchored(planes, bits: int, length: int, gram: int):
    """Stretches of windows with the same anchor, where it is estimated repeated."""

    def task(batches):
        for batch in batches:
            ids, keys = _keys_of(batch)
            for low, _, found, _, at, anchor in _stretches(batch, length, gram):
                text = np.searchsorted(found.first, at, "right") - 1
                begins = np.ones(len(at), bool)
                begins[1:] = (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                head = np.flatnonzero(begins)
                count = np.diff(np.append(head, len(at)))
                flagged = sketch.reached(planes.value, anchor[head], bits)
                head, count = head[flagged], count[flagged]
                text = text[head]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(anchor[head]),
                        pa.array(ids[low + text]),
                        pa.array(keys[low + text]),
                        pa.array((at[head] - found.first[text]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    names=["_anchor", "_id", "_key", "_start", "_n"],
                )

    return task


def _runs_of(length: int, gram: int):
    def task(batches):
        for batch in batches:
            ids, keys = _keys_of(batch)
            for low, data, found, hashes, at, _ in _stretches(batch, length, gram):
                text = np.searchsorted(found.first, at, "right") - 1
                begins = np.ones(len(at), bool)
                begins[1:] = (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
                head = np.flatnonzero(begins)
                count = np.diff(np.append(head, len(at)))
                start, text = at[head], text[head]
                stop = start + count + length - 1
                digest = [
                    scan.mix(scan.Prefix(h, w).span(start, stop) + count.astype(np.uint64))
                    for w, h in ((0, hashes), (1, scan.word_hashes(data, found, 1)))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[low + text]),
                        pa.array(keys[low + text]),
                        pa.array((start - found.first[text]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        _signed(digest[0]),
                        _signed(digest[1]),
                    ],
                    names=["_id", "_key", "_start", "_n", "_hi", "_lo"],
                )

    return task


def _windows_of(planes, bits: int, length: int, gram: int):
    """The windows whose anchor is estimated repeated."""

    def task(batches):
        for batch in batches:
            ids, keys = _keys_of(batch)
            for low, data, found, hashes, at, anchor in _stretches(batch, length, gram):
                at = at[sketch.reached(planes.value, anchor, bits)]
                if not len(at):
                    continue
                text = np.searchsorted(found.first, at, "right") - 1
                digest = [
                    scan.Prefix(h, w).every(length)[at] for w, h in ((0, hashes), (1, scan.word_hashes(data, found, 1)))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[low + text]),
                        pa.array(keys[low + text]),
                        pa.array((at - found.first[text]).astype(np.int32)),
                        _signed(digest[0]),
                        _signed(digest[1]),
                    ],
                    names=["_id", "_key", "_start", "_hi", "_lo"],
                )

    return task


def _several(rows: DataFrame, same: list[str]) -> DataFrame:
    """The smallest id of each digest that occurs under more than one id.

    Stored before it is joined: a join splits a hot key only between plain exchanges.
    """
    ends = rows.groupBy(*same).agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    return ends.where("_first < _last").drop("_last")


def _with_segments(texts: DataFrame, stretches: DataFrame) -> DataFrame:
    """The texts that have stretches, with those (as many as the text has room for)."""
    own = stretches.groupBy("_id", "_key").agg(F.sort_array(F.collect_set(F.struct("_start", "_n"))).alias("_segments"))
    return texts.join(own, ["_id", "_key"])


def _covered(runs: DataFrame, length: int) -> DataFrame:
    return runs.where("_id > _first").select(
        "_id", "_key", "_start", (F.col("_start") + F.col("_n") + (length - 1)).alias("_stop")
    )


def removed_spans(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, max_bits: int = sketch.MAX_BITS
) -> DataFrame:
    """Word ranges to remove, per (`_id`, `_key`): `_spans` of `_start` and `_stop`, ordered."""
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = sketch.bits_for(size // _BYTES_PER_ANCHOR, max_bits)
    context = texts.sparkSession.sparkContext
    # anchors: estimated, then exactly
    planes = context.broadcast(sketch.build(texts, _anchor_keys(length, gram), bits))
    anchored = kept(
        texts.mapInArrow(_anchored(planes, bits, length, gram), "_anchor long, _id long, _key long, _start int, _n int"),
        "anchored",
    )
    planes.unpersist()
    several = kept(_several(anchored, ["_anchor"]), "several")
    rivals = kept(_with_segments(texts, anchored.join(several, "_anchor").drop("_first")), "rivals")
    forget(anchored, several)
    # runs: the smallest id owns one, the others are copies
    same = ["_hi", "_lo", "_n"]
    found = kept(rivals.mapInArrow(_runs_of(length, gram), _RUNS), "found")
    several = kept(_several(found, same), "several")
    runs = kept(found.join(several, same, "left").withColumn("_first", F.coalesce("_first", "_id")), "runs")
    owners = kept(_with_segments(rivals.drop("_segments"), runs.where("_id = _first")), "owners")
    forget(found, several, rivals)
    # windows: estimated among the owners, then exactly
    planes = context.broadcast(sketch.build(owners, _anchor_keys(length, gram), bits))
    windows = kept(
        owners.mapInArrow(_windows_of(planes, bits, length, gram), "_id long, _key long, _start int, _hi long, _lo long"),
        "windows",
    )
    planes.unpersist()
    forget(owners)
    same = ["_hi", "_lo"]
    several = kept(_several(windows, same), "several")
    late = windows.join(several, same).withColumn("_n", F.lit(1))
    covered = kept(_covered(runs, length).unionByName(_covered(late, length)), "covered")
    forget(runs, windows, several)
    return covered.groupBy("_id", "_key").agg(F.sort_array(F.collect_list(F.struct("_start", "_stop"))).alias("_spans"))


def _cut(text_column: str):
    def task(batches):
        for batch in batches:
            doc, spans = batch.column("_doc"), batch.column("_spans")
            total, gone, rest = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for low, high, data, off in scan.blocks(pc.struct_field(doc, [text_column])):
                found = scan.words(data, off, scan.BLANK_SEPARATED)
                here = spans.slice(low, high - low)
                owner = np.repeat(np.arange(high - low), np.diff(np.asarray(here.offsets)))
                flat = here.flatten()
                drop = np.zeros(len(found.start) + 1, np.int32)
                np.add.at(drop, found.first[:-1][owner] + np.asarray(flat.field(0)), 1)
                np.add.at(drop, found.first[:-1][owner] + np.asarray(flat.field(1)), -1)
                stay = np.cumsum(drop[:-1]) == 0
                kept_before = np.concatenate(([0], np.cumsum(stay)))[found.first]
                counts = np.diff(found.first)
                total.append(counts)
                gone.append(counts - np.diff(kept_before))
                start, stop = found.start[stay], found.stop[stay]
                rest += [
                    scan.joined(data, start[a:b], stop[a:b]).decode()
                    for a, b in zip(kept_before[:-1].tolist(), kept_before[1:].tolist())
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    doc,
                    pa.array(np.concatenate(total), pa.int64()),
                    pa.array(np.concatenate(gone), pa.int64()),
                    pa.array(rest, pa.string()),
                ],
                names=["_doc", "n_words", "n_removed", "kept_text"],
            )

    return task


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    max_bits: int = sketch.MAX_BITS,
) -> DataFrame:
    """`docs` with `n_words`, `n_removed` and `kept_text` (the kept words joined by one space).

    Columns of these names are replaced; all others pass through.  `max_bits` bounds the size of
    the sketch, see `sketch.bits_for`; it has no influence on the result.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram must be from 1 to length")
    # the text tells apart rows of the same id
    keyed = packed(docs).select(
        "_doc",
        doc_field(id_column).cast("long").alias("_id"),
        F.xxhash64(doc_field(text_column)).alias("_key"),
        doc_field(text_column).alias("_text"),
    )
    texts = keyed.where("_id is not null and _text is not null").select("_id", "_key", "_text")
    spans = removed_spans(texts, length, gram, max_bits)
    none = F.array().cast("array<struct<_start:int,_stop:int>>")
    ready = keyed.join(spans, ["_id", "_key"], "left").select("_doc", F.coalesce("_spans", none).alias("_spans"))
    layout = keyed.select("_doc").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return unpacked(ready.mapInArrow(_cut(text_column), layout), docs, "n_words", "n_removed", "kept_text")


def digest(kept_docs: DataFrame) -> DataFrame:
    """One row per document: its counts and the SHA-256 of what was kept."""
    return kept_docs.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
