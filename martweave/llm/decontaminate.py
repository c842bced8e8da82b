"""Benchmark passages in training documents, found by winnowing fingerprints.

A benchmark window is `window` consecutive words of an item; an item of fewer words is one
window.  A document word is hit where it lies inside an occurrence of a benchmark window.

*Winnowing.*  Of every `window - gram + 1` consecutive gram hashes (`gram` words each, all
inside one window) the smallest is kept, the last one among equals.  The choice depends on
the window's words alone, so wherever a document shares a whole window with an item, both
keep the same gram at the same place of it: every shared span of `window` words is found.
Items shorter than a window are looked up whole, by their length.

*Join.*  The items' fingerprints set the bits of a filter of known size, which is broadcast;
document fingerprints outside it occur in no item and are dropped where they are made.  The
rest are joined with the items' fingerprints by hash.  Both sides carry the hashes of the
words around the gram, so a match is verified and extended word by word within the joined
row, to both sides as far as any window over the gram can reach.

A document's spans are merged at the end; its text is not shuffled.  Nulls: a null text has no
words, an item without id is not looked for, a document without id is judged like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import scan, sketch
from .store import doc_field, kept, packed, unpacked

WINDOW = 10
GRAM = 5
# filter cells per fingerprint of the benchmark, over the eight of `sketch.bits_for`
_SPARSE = 4

_HIT = "array<struct<size:int,at:int,hash:long,around:array<long>>>"


def _winnowed(hashes: np.ndarray, found: scan.Words, window: int, gram: int) -> np.ndarray:
    """Starts of the kept grams.

    Places are ranked by the hash's upper half; among equals the later place is the smaller.
    """
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    grams = scan.Prefix(hashes).every(gram)
    low = np.uint64(0xFFFFFFFF)
    ranked = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    least = scan.sliding_min(ranked, window - gram + 1)
    text = np.searchsorted(found.first, np.arange(len(least)), "right") - 1
    whole = np.arange(len(least)) + window <= found.first[text + 1]
    chosen = (low - (least[whole] & low)).astype(np.int64)
    return chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))] if len(chosen) else chosen


def _around(hashes: np.ndarray, found: scan.Words, text: np.ndarray, at: np.ndarray, reach: range, edge: int):
    """Word hashes around each place, `edge` where the text has ended."""
    places = at[:, None] + np.array(reach)
    outside = (places < found.first[text][:, None]) | (places >= found.first[text + 1][:, None])
    result = hashes[np.clip(places, 0, max(len(hashes) - 1, 0))]
    result[outside] = edge
    return result


def _marks(hashes: np.ndarray, found: scan.Words, window: int, gram: int, sizes: list[int], items: bool):
    """(size, places, hashes) of all fingerprints: winnowed ones, and whole short spans.

    The hash of a short span is salted with its length.
    """
    at = _winnowed(hashes, found, window, gram)
    yield window, at, scan.Prefix(hashes).every(gram)[at] if len(at) else np.zeros(0, np.uint64)
    counts = np.diff(found.first)
    for size in sizes:
        if items:
            at = found.first[:-1][counts == size]
        else:
            start = np.arange(max(0, len(hashes) - size + 1))
            text = np.searchsorted(found.first, start, "right") - 1
            at = start[start + size <= found.first[text + 1]]
        every = scan.Prefix(hashes).every(size)
        yield size, at, scan.mix(every[at] + np.uint64(size)) if len(at) else np.zeros(0, np.uint64)


def _list(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel().view(np.int64)))


def _scan(column: str, key: str, window: int, gram: int, sizes: list[int], items: bool, planes=None, bits: int = 0):
    """Rows of (key, n_words, fingerprints); documents keep only fingerprints in the filter."""
    reach = range(gram - window, window)
    edge = 1 if items else 2  # so that ends of texts never look alike

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, off in scan.blocks(batch.column(column)):
                found = scan.words(data, off, scan.ALPHANUMERIC)
                hashes = scan.word_hashes(data, found, fold=True)
                parts = []
                for size, at, marks in _marks(hashes, found, window, gram, sizes, items):
                    if planes is not None:
                        some = sketch.reached(planes.value, marks, bits)
                        at, marks = at[some], marks[some]
                    text = np.searchsorted(found.first, at, "right") - 1
                    around = _around(hashes, found, text, at, reach, edge) if len(at) else np.zeros((0, len(reach)), np.uint64)
                    parts.append((text, np.full(len(at), size), at - found.first[text], marks, around))
                text, size, at, marks, around = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(text, kind="stable")
                per_text = np.searchsorted(text[order], np.arange(high - low + 1)).astype(np.int32)
                hits = pa.StructArray.from_arrays(
                    [
                        pa.array(size[order].astype(np.int32)),
                        pa.array(at[order].astype(np.int32)),
                        pa.array(marks[order].view(np.int64)),
                        _list(np.ascontiguousarray(around[order])),
                    ],
                    names=["size", "at", "hash", "around"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(low, high - low),
                        pa.array(np.diff(found.first).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(per_text), hits),
                    ],
                    names=[key, "n_words", "marks"],
                )

    return task


def _filter_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield np.unique(np.asarray(batch.column("hash")).view(np.uint64))


def _agreeing(ours: str, theirs: str, places: range) -> Column:
    """How many of the places agree in a row, counted from the end of the range backwards."""
    run = F.lit(0)
    for place in places:
        same = F.element_at(ours, place + 1) == F.element_at(theirs, place + 1)
        run = F.when(same, run + 1).otherwise(0)
    return run


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    item_column: str = "item_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per row of `docs`, without its text.

    `_doc`: its other columns; `n_words`; `spans`: the word ranges hit, merged and ordered;
    `items`: the ids of the items that have an occurring window, as strings, ordered.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be from 1 to window")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]) if len(docs.columns) > 1 else F.struct()
    items = benchmark.select(F.col(item_column).cast("string").alias("_item"), F.col(text_column).alias("_text")).where(
        "_item is not null"
    )
    words = F.regexp_count(F.col("_text"), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    counted = items.select(words.alias("_n")).where(f"_n > 0 and _n < {window}").distinct()
    sizes = sorted(r[0] for r in counted.collect())  # fewer than `window` numbers
    layout = f"_item string, n_words long, marks {_HIT}"
    theirs = kept(items.mapInArrow(_scan("_text", "_item", window, gram, sizes, True), layout), "items")
    marks = theirs.select("_item", F.explode("marks").alias("m")).select(
        "_item", "m.size", "m.hash", F.col("m.around").alias("theirs")
    )
    bits = sketch.bits_for(_SPARSE * marks.count())
    planes = sketch.build(marks.select("hash"), _filter_keys, bits, least=1)
    shared = docs.sparkSession.sparkContext.broadcast(planes)
    rows = docs.select(others.alias("_key"), F.col(text_column).alias("_text"))
    layout = rows.select("_key").schema.add("n_words", "long").add(StructType.fromDDL(f"marks {_HIT}")["marks"])
    scanned = kept(
        rows.mapInArrow(_scan("_text", "_key", window, gram, sizes, False, shared, bits), layout).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "scanned",
    )
    ours = scanned.select("_row", F.explode("marks").alias("m")).select(
        "_row", "m.at", "m.size", "m.hash", F.col("m.around").alias("ours")
    )
    first = window - gram  # the index of the gram's first word in `around`
    middle = F.slice("ours", first + 1, gram) == F.slice("theirs", first + 1, gram)
    left = _agreeing("ours", "theirs", range(0, first))
    right = _agreeing("ours", "theirs", range(first + window - 1, first + gram - 1, -1))
    short = F.col("size") < window
    spelt = F.slice("ours", F.lit(first + 1), F.col("size")) == F.slice("theirs", F.lit(first + 1), F.col("size"))
    met = ours.join(marks, ["size", "hash"]).select(
        "_row",
        "_item",
        F.when(short, spelt).otherwise(middle & (left + right >= window - gram)).alias("_same"),
        (F.col("at") - F.when(short, 0).otherwise(left)).alias("start"),
        (F.col("at") + F.when(short, F.col("size")).otherwise(gram + right)).alias("stop"),
    )
    met = kept(met.where("_same").drop("_same").distinct(), "met")
    found = met.groupBy("_row").agg(F.sort_array(F.collect_set("_item")).alias("items"))
    spans = _merged(met.select("_row", "start", "stop").distinct())
    none = F.array().cast("array<struct<start:int,stop:int>>")
    judged = scanned.select("_row", "_key", "n_words").join(found, "_row", "left").join(spans, "_row", "left")
    return judged.select(
        F.col("_key").alias("_doc"),
        "n_words",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _merged(spans: DataFrame) -> DataFrame:
    """Per `_row` its spans in order, those that overlap or touch joined."""
    earlier = Window.partitionBy("_row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("_row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("start") > F.max("stop").over(earlier), F.lit(True)).cast("int")
    islands = spans.withColumn("_new", apart).withColumn("_island", F.sum("_new").over(so_far))
    joined = islands.groupBy("_row", "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return joined.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def digest(judged: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return judged.select(
        F.col("_doc.doc_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that hold no benchmark window."""
    keyed = packed(docs).select(
        "_doc", doc_field(id_column).alias("_id"), F.xxhash64(doc_field(text_column)).alias("_key"), doc_field(text_column).alias("text")
    )
    judged = occurrences(keyed.select("_id", "_key", "text"), benchmark, **options)
    hit = judged.where(F.size("spans") > 0).select(F.col("_doc._id").alias("_hit"), F.col("_doc._key").alias("_hit_key"))
    same = F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_key") == F.col("_hit_key"))
    return unpacked(keyed.join(hit.distinct(), same, "left_anti").select("_doc"), docs)
