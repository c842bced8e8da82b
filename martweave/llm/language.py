"""Language identification by prediction by partial matching (PPM).

Per language a tree of byte contexts of up to `ORDER` bytes holds how often each byte followed.
A text's code length in a language is the sum, over its bytes, of what an arithmetic coder with
these frozen counts would spend: the longest known context codes the byte if it has seen it;
else it codes an escape (method C: as many chances as distinct successors) and the next shorter
context tries; below the empty context all bytes cost eight bits.  The language with the
shortest code is predicted.

*Fit.*  The counts come from at most `ROWS` texts per language (a documented bound, drawn by
hash), read whole, and are summed by Spark; every context and successor of these texts counts.
The model follows the distinct ones, a few megabytes a language for texts of usual length.

*Score.*  Whole texts, in blocks: a byte with its context is a 32-bit number, so a block is
looked up in arrays, and the costs of all languages come back as one row.

Nulls: a row without text, language or id is not learned from; a text that is null or has no
letter is `und`, score 0.  Capitals A-Z count as small letters.  Ties go to the first label in
code point order.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan
from .store import doc_field, packed, unpacked

ORDER = 3
ROWS = 400
UNKNOWN = "und"
_BLANK = 0x20
_HASH_SPACE = 1 << 40
# with so many times the rows wanted, the chance that the first cut is short is negligible
_SPARE = 3
_SLOT_BITS = 20
_SLOT_FACTOR = np.uint32(0x9E3779B1)


class Model(NamedTuple):
    """Per order: sorted grams (context and byte) with their cost in every language, and
    sorted contexts with the cost of escaping from them."""

    labels: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]


def learnable(id_column: str = "doc_id") -> Column:
    """Rows that may be learned from; the others are held out."""
    return F.crc32(F.col(id_column).cast("string")) % 5 != 0


def _grams(data: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Every byte with the `order` bytes before it; blanks stand before a text's start."""
    folded = scan.LOWER[data].astype(np.uint32)
    grams = folded.copy()
    for back in range(1, order + 1):
        before = np.full(len(data), _BLANK, np.uint32)
        before[back:] = folded[:-back] if back < len(data) else folded[:0]
        for ahead in range(back):
            at = off[:-1] + ahead
            before[at[at < off[1:]]] = _BLANK
        grams |= before << np.uint32(8 * back)
    return grams


def _counts(order: int):
    def task(batches):
        for batch in batches:
            labels = batch.column("_label").to_pylist()
            texts = batch.column("_text")
            for label in sorted(set(labels)):
                own = texts.filter(pa.array([x == label for x in labels]))
                for _, _, data, off in scan.blocks(own):
                    for k in range(order + 1):
                        grams, n = np.unique(_grams(data, off, k), return_counts=True)
                        rows = [[label] * len(grams), [k] * len(grams), grams.astype(np.int64), n]
                        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(r, t) for r, t in zip(rows, kinds)], names=["label", "k", "gram", "n"]
                        )

    return task


def fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    rows: int = ROWS,
    order: int = ORDER,
) -> Model:
    """The model of the labelled rows of `docs`; the caller leaves out what is held out."""
    if not 0 <= order <= 3:
        raise ValueError("order must be from 0 to 3")
    known = docs.select(
        F.col(id_column).alias("_id"), F.col(label_column).alias("_label"), F.col(text_column).alias("_text")
    )
    usable = known.where("_id is not null and _label is not null and _text is not null")
    draw = F.pmod(F.xxhash64("_id"), F.lit(_HASH_SPACE))
    ids = usable.select("_id", "_label", draw.alias("_draw"))
    # a first cut by hash leaves some `_SPARE * rows` ids of a language, however many it has
    share = ids.groupBy("_label").agg((F.lit(float(_SPARE * rows)) / F.count(F.lit(1))).alias("_share"))
    # one row per language; the model holds far more for each
    near = ids.join(F.broadcast(share), "_label").where(F.col("_draw") < F.col("_share") * _HASH_SPACE)
    by_draw = Window.partitionBy("_label").orderBy("_draw", "_id")
    chosen = near.withColumn("_n", F.row_number().over(by_draw)).where(F.col("_n") <= rows)
    # at most `rows` ids per language
    sample = usable.join(F.broadcast(chosen.select("_id").distinct()), "_id", "left_semi")
    counts = sample.select("_label", "_text").mapInArrow(
        _counts(order), "label string, k int, gram long, n long"
    ).groupBy("label", "k", "gram").agg(F.sum("n").alias("n"))
    return model_of(counts.toPandas(), order)


def model_of(table, order: int = ORDER) -> Model:
    """The model of a table of counts (`label`, `k`, `gram`, `n`)."""
    labels = sorted(table["label"].unique().tolist())
    number = table["label"].map({x: i for i, x in enumerate(labels)}).to_numpy(np.int64)
    ks, all_grams, n = (table[c].to_numpy() for c in ("k", "gram", "n"))
    model = Model(labels, [], [], [], [])
    for k in range(order + 1):
        here = ks == k
        gram, label, count = all_grams[here].astype(np.uint32), number[here], n[here].astype(float)
        keys, at = np.unique(gram, return_inverse=True)
        seen = np.zeros((len(keys), len(labels)))
        seen[at, label] = count
        contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
        total = np.zeros((len(contexts), len(labels)))
        kinds = np.zeros_like(total)
        np.add.at(total, of, seen)
        np.add.at(kinds, of, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            # a context that a language has never seen costs nothing to leave
            escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
            direct = np.log2((total + kinds)[of] / seen)
        low = np.uint32((1 << (8 * k)) - 1)
        shorter = np.full(seen.shape, 8.0) if k == 0 else code_lengths(model, keys & low, k - 1)
        model.grams.append(keys)
        model.costs.append(np.where(seen > 0, direct, escape[of] + shorter).astype(np.float32))
        model.contexts.append(contexts)
        model.escapes.append(escape.astype(np.float32))
    return model


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def code_lengths(model: Model, grams: np.ndarray, order: int, slots: np.ndarray | None = None) -> np.ndarray:
    """Bits for the last byte of each gram, per language.

    `slots` maps hashed grams of the highest order to their place, which saves most searches.
    """
    keys = model.grams[order]
    if slots is not None and len(keys):
        at = slots[(grams * _SLOT_FACTOR) >> np.uint32(32 - _SLOT_BITS)]
        unsure = np.flatnonzero(keys[at] != grams)
        at[unsure], found = _find(keys, grams[unsure])
        missing = unsure[~found]
    else:
        at, found = _find(keys, grams)
        missing = np.flatnonzero(~found)
    costs = model.costs[order][at] if len(keys) else np.zeros((len(grams), len(model.labels)), np.float32)
    if len(missing):
        rest = grams[missing]
        if order == 0:
            costs[missing] = model.escapes[0][0] + 8.0 if len(keys) else 8.0
        else:
            where, known = _find(model.contexts[order], rest >> np.uint32(8))
            escape = np.where(known[:, None], model.escapes[order][where], 0.0) if len(keys) else 0.0
            costs[missing] = escape + code_lengths(model, rest & np.uint32((1 << (8 * order)) - 1), order - 1)
    return costs


def _slots(keys: np.ndarray) -> np.ndarray:
    slots = np.zeros(1 << _SLOT_BITS, np.int32)
    slots[(keys * _SLOT_FACTOR) >> np.uint32(32 - _SLOT_BITS)] = np.arange(len(keys), dtype=np.int32)
    return slots


def text_lengths(model: Model, data: np.ndarray, off: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Code length of each text of a block, per language, in bits."""
    order = len(model.grams) - 1
    result = np.zeros((len(off) - 1, len(model.labels)))
    grams = _grams(data, off, order)
    for low in range(0, len(data), scan.BLOCK_BYTES // 4):
        part = code_lengths(model, grams[low : low + scan.BLOCK_BYTES // 4], order, slots)
        high = low + len(part)
        first, last = np.searchsorted(off, low, "right") - 1, np.searchsorted(off, high)
        begins = np.clip(off[first:last], low, high) - low
        sizes = np.diff(np.append(begins, high - low))
        some = np.flatnonzero(sizes)
        result[first + some] += np.add.reduceat(part, begins[some], axis=0, dtype=np.float64)
    return result


def _predict(shared):
    def task(batches):
        model = Model(*shared.value)
        slots = _slots(model.grams[-1])
        for batch in batches:
            names, scores, rates = [], [], []
            for _, _, data, off in scan.blocks(batch.column("_text")):
                bits = text_lengths(model, data, off, slots)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                names += [model.labels[i] for i in best.tolist()]
                scores.append(1.0 / np.exp2(least[:, None] - bits).sum(axis=1))
                rates.append(least / np.maximum(np.diff(off), 1))
            none = [np.zeros(0)]
            columns = [
                batch.column("_doc"),
                batch.column("_has_letter"),
                pa.array(names, pa.string()),
                pa.array(np.concatenate(scores or none)),
                pa.array(np.concatenate(rates or none)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", "_has_letter", "_best", "_score", "_rate"])

    return task


def predict(docs: DataFrame, model: Model, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `carry`) with three columns more, which replace those of the same name.

    `lang_pred`; `score`: the share of the predicted language if each language's code length is
    read as a likelihood; `bits_per_byte`: the shortest code's rate, null for `und`.
    """
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    rows = packed(docs).select(
        F.struct(*[doc_field(c).alias(c) for c in wanted.columns]).alias("_doc"),
        doc_field(text_column).alias("_text"),
        F.coalesce(doc_field(text_column).rlike(r"\p{L}"), F.lit(False)).alias("_has_letter"),
    )
    known = F.col("_has_letter")
    if model.labels:
        layout = rows.select("_doc", "_has_letter").schema
        layout = layout.add("_best", "string").add("_score", "double").add("_rate", "double")
        shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
        judged = rows.mapInArrow(_predict(shared), layout)
    else:  # nothing was learned
        judged, known = rows.withColumns({"_best": F.lit(UNKNOWN), "_score": F.lit(0.0), "_rate": F.lit(8.0)}), F.lit(False)
    named = judged.select(
        "_doc",
        F.when(known, F.col("_best")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(known, F.col("_score")).otherwise(F.lit(0.0)).alias("score"),
        F.when(known, F.col("_rate")).alias("bits_per_byte"),
    )
    return unpacked(named, wanted, "lang_pred", "score", "bits_per_byte")
