"""SimHash near-duplicate groups: fingerprints, links within a few bits, connected groups.

*Fingerprints.*  Per text, the XXH64 of every shingle votes on each of the 64 bits.

*Candidates.*  Only distinct fingerprints are compared, however many copies they stand for.
The 64 bits are cut into five blocks; two fingerprints within three bits agree in at least
two whole blocks, so the ten choices of two blocks are ten bucket keys of about 26 bits and
every link meets in some bucket.

*Bit-sliced comparison.*  A tile of whole buckets is stored as bit planes: word k of plane b
holds bit b of 64 fingerprints.  One exclusive-or compares a query with 64 fingerprints in
that bit, and carry-save counters (one bit plane per binary digit) add it up; a counter that
runs over the radius sticks.  Cells of 64 fingerprints that are all beyond the radius are
abandoned and the later planes are read for the remaining cells only.  A bucket larger than
`PART` is compared as pairs of parts, each pair in a unit of its own, so none is cut short.

*Groups.*  A tile returns its links as a forest (at most one row per fingerprint), never as
all pairs.  Components of all forests give the groups.

Null and empty texts have the fingerprint zero.  Rows without id get a fingerprint and their
group's id; they do not name a group (a group without any id has none).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .components import components
from .store import KEYS, doc_field, kept, one_of_equal_rows, packed, row_keys, unpacked

SHINGLE = 3
RADIUS = 3
SEED = 42
PART = 8192
_TILE = 2048
_QUERIES = 128
_BLOCKS = (13, 13, 13, 13, 12)
_SLAB = 1 << 17


def _shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    tokens = raw.lower().split()  # on bytes: A-Z only, and blanks 09-0D and 20
    if not tokens:
        return np.zeros(0, np.uint64)
    text = b" ".join(tokens)
    stops = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    if len(tokens) > size:
        starts, stops = starts[: 1 - size or None], stops[size - 1 :]
    else:
        starts, stops = starts[:1], stops[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(text[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for low in range(0, len(hashes), _SLAB):
        part = hashes[low : low + _SLAB].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(size: int):
    def task(batches):
        for batch in batches:
            marks = []
            for _, _, data, off in scan.blocks(batch.column("_text")):
                raw = data.tobytes()
                hashes = [_shingle_hashes(raw[a:b], size) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                marks += _many(hashes)
            out = pa.array(np.array(marks, np.uint64).view(np.int64))
            columns = [batch.column("_doc"), batch.column("_id"), out]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", "_id", "_mark"])

    return task


def _many(groups: list[np.ndarray]) -> list[int]:
    """Fingerprints of many short texts at once; a long text is counted by itself."""
    result, at = [0] * len(groups), 0
    while at < len(groups):
        end, total = at, 0
        while end < len(groups) and (total == 0 or total + len(groups[end]) <= _SLAB):
            total += len(groups[end])
            end += 1
        if end == at + 1:
            result[at] = fingerprint(groups[at])
        else:
            sizes = np.array([len(g) for g in groups[at:end]])
            some = np.flatnonzero(sizes)
            bits = np.unpackbits(np.concatenate(groups[at:end]).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            if len(some):
                begins = (np.cumsum(sizes) - sizes)[some]
                votes = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
                marks = np.packbits(votes * 2 > sizes[some, None], axis=1)
                for i, row in zip(some.tolist(), marks):
                    result[at + i] = int.from_bytes(row.tobytes(), "big")
        at = end
    return result


def _planes(marks: np.ndarray) -> np.ndarray:
    """Bit b of fingerprint i as bit i % 64 of word i // 64 of plane b."""
    padded = np.zeros(-(-len(marks) // 64) * 64, np.uint64)
    padded[: len(marks)] = marks
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed_bits = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return packed_bits.view("<u8").astype(np.uint64)


class _Counters:
    """Carry-save counters: `digits[k]` holds binary digit k of 64 counts a word."""

    def __init__(self, shape, radius: int):
        self.digits = [np.zeros(shape, np.uint64) for _ in range(radius.bit_length())]
        self.over = np.zeros(shape, np.uint64)

    def add(self, carry: np.ndarray) -> None:
        for k, digit in enumerate(self.digits):
            onward = digit & carry
            self.digits[k] = digit ^ carry
            carry = onward
        self.over |= carry

    def keep(self, which: np.ndarray) -> None:
        self.digits = [d[which] for d in self.digits]
        self.over = self.over[which]


def close_pairs(marks: np.ndarray, radius: int):
    """Yields arrays (i, j), i < j, of all pairs within `radius` bits, some queries at a time."""
    planes, all_set = _planes(marks), ~np.uint64(0)
    last = np.zeros(planes.shape[1], np.uint64)
    rest = len(marks) - (len(last) - 1) * 64
    last[-1] = 0 if rest == 64 else all_set << np.uint64(rest)
    for low in range(0, len(marks), _QUERIES):
        own = marks[low : low + _QUERIES]
        masks = np.where((own[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1, all_set, np.uint64(0))
        # earlier words were compared when their fingerprints were the queries
        first = low // 64
        query, word = (x.ravel() for x in np.mgrid[: len(own), first : planes.shape[1]])
        counters = _Counters(len(query), radius)
        counters.over |= last[word]
        for step in range(0, 64, 8):
            for b in range(step, step + 8):
                counters.add(planes[b][word] ^ masks[query, b])
            alive = np.flatnonzero(counters.over != all_set)
            if len(alive) < 0.75 * len(query):
                counters.keep(alive)
                query, word = query[alive], word[alive]
            if not len(query):
                break
        if len(query):
            near = np.unpackbits((~counters.over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cell, bit = np.nonzero(near)
            i, j = query[cell] + low, word[cell] * 64 + bit
            ordered = i < j
            i, j = i[ordered], j[ordered]
            if radius + 1 & radius:  # the counters only tell counts up to the next power of two
                exact = np.bitwise_count(marks[i] ^ marks[j]) <= radius
                i, j = i[exact], j[exact]
            yield i, j


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b); a label is the smallest index of its group."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (up := labels[labels]).tobytes() != labels.tobytes():
            labels = up


def _tile_links(marks: np.ndarray, radius: int) -> pa.RecordBatch | None:
    marks = np.unique(marks)
    labels = np.arange(len(marks))
    for a, b in close_pairs(marks, radius):
        labels = _join(labels, a, b)
    moved = np.flatnonzero(labels != np.arange(len(marks)))
    if not len(moved):
        return None
    ends = [pa.array(marks[x].view(np.int64)) for x in (moved, labels[moved])]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def _links(radius: int):
    def task(batches):
        held = np.zeros(0, np.uint64)
        units = np.zeros(0, np.int64)
        for batch in batches:
            held = np.concatenate([held, np.asarray(batch.column("_mark")).view(np.uint64)])
            units = np.concatenate([units, np.asarray(batch.column("_unit"))])
            if len(held) < _TILE:
                continue
            # whole units only; the last may go on in the next batch
            cuts = np.flatnonzero(units[1:] != units[:-1]) + 1
            if len(cuts):
                yield from _tiles(held[: cuts[-1]], units[: cuts[-1]], radius)
                held, units = held[cuts[-1] :], units[cuts[-1] :]
        yield from _tiles(held, units, radius)

    return task


def _tiles(marks: np.ndarray, units: np.ndarray, radius: int):
    if len(marks) < 2:
        return
    begins = np.concatenate(([0], np.flatnonzero(units[1:] != units[:-1]) + 1))
    sizes = np.diff(np.append(begins, len(units)))
    shared = np.repeat(sizes > 1, sizes)
    marks, sizes = marks[shared], sizes[sizes > 1]
    stops = np.cumsum(sizes)
    low = 0
    while low < len(marks):
        nth = min(int(np.searchsorted(stops, low + _TILE)), len(stops) - 1)
        links = _tile_links(marks[low : stops[nth]], radius)
        if links is not None:
            yield links
        low = int(stops[nth])


def _bucket_keys(radius: int):
    """All choices of blocks that two close fingerprints must agree in, as (table, blocks)."""
    if radius >= len(_BLOCKS):
        raise ValueError(f"the radius must be below {len(_BLOCKS)}")
    low, blocks = 0, []
    for width in _BLOCKS:
        blocks.append(F.shiftrightunsigned("_mark", low).bitwiseAND(F.lit((1 << width) - 1)))
        low += width
    keys = []
    for nth, chosen in enumerate(combinations(blocks, len(_BLOCKS) - radius)):
        key = F.lit(nth).cast("long")
        for block in chosen:
            key = F.shiftleft(key, max(_BLOCKS)).bitwiseOR(block)
        keys.append(key)
    return F.explode(F.array(*keys)).alias("_bucket")


def links(marks: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Links (`a`, `b`) that connect all distinct `_mark`s within `radius` bits of each other."""
    keyed = marks.select("_mark", _bucket_keys(radius))
    large = (
        keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part)
        .select("_bucket", F.ceil(F.col("_n") / part).alias("_parts"))
    )
    own = F.pmod(F.xxhash64("_mark"), F.col("_parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    split = (
        keyed.join(large, "_bucket").select("_mark", "_bucket", own.alias("_own"), other.alias("_other"))
        .select("_mark", F.xxhash64("_bucket", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_unit"))
    )
    whole = keyed.join(large, "_bucket", "left_anti").select("_mark", F.xxhash64("_bucket").alias("_unit"))
    units = whole.unionByName(split).repartition("_unit").sortWithinPartitions("_unit")
    return units.mapInArrow(_links(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    carry: list[str] | None = None,
) -> DataFrame:
    """`docs` (or its columns `carry`) with three columns more, which replace those of the same name.

    `fingerprint`: 16 hex digits; `component_id`: the smallest id of the group; `is_first`: true
    for exactly one row of each group, one with the smallest id.
    """
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    both = packed(docs).select("_doc", doc_field(text_column).alias("_text"), doc_field(id_column).alias("_id"))
    if carry:
        both = both.withColumn("_doc", F.struct(*[doc_field(c).alias(c) for c in carry]))
    layout = both.select("_doc", "_id").schema.add("_mark", "long")
    # the row numbers are fixed by being written
    marked = kept(
        both.mapInArrow(_fingerprints(shingle), layout).withColumn("_row", F.monotonically_increasing_id()), "marked"
    )
    named = marked.join(grouped(marked, radius), "_mark", "left").select(
        "_doc",
        F.lpad(F.lower(F.hex("_mark")), 16, "0").alias("fingerprint"),
        "component_id",
        (F.col("_row") == F.col("_first_row")).alias("is_first"),
    )
    return unpacked(named, wanted, "fingerprint", "component_id", "is_first")


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row of `docs` per group, one with the smallest id.

    Only fingerprints, ids and digests of rows are stored and grouped; whole rows move once.
    """
    narrow = docs.select(
        *row_keys([F.col(f"`{c}`") for c in docs.columns]),
        F.col(f"`{id_column}`").alias("_id"),
        F.col(f"`{text_column}`").alias("_text"),
    )
    marked = near_duplicates(narrow, "_id", "_text", carry=list(KEYS), **options)
    first = marked.where("is_first").select(*KEYS)
    return unpacked(one_of_equal_rows(docs).join(first, list(KEYS)), docs)


def grouped(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per distinct `_mark` the smallest `_id` of its group, and the `_row` that has it."""
    first = F.min(F.struct(F.col("_id").isNull(), F.col("_id").alias("id"), F.col("_row").alias("row")))
    distinct = kept(marked.groupBy("_mark").agg(first.alias("_least")), "distinct")
    roots = components(links(distinct.select("_mark"), radius)).withColumnRenamed("node", "_mark")
    rooted = distinct.join(roots, "_mark", "left").select("_mark", "_least", F.coalesce("root", "_mark").alias("_root"))
    names = rooted.groupBy("_root").agg(F.min("_least").alias("_first"))
    return rooted.join(names, "_root").select(
        "_mark", F.col("_first.id").alias("component_id"), F.col("_first.row").alias("_first_row")
    )
