"""Toxicity scores from averaged subword embeddings and a linear softmax.

A text is the bag of its words' subwords: every word, and its byte n-grams of 3 to 7 bytes
between end marks, so a misspelt word shares most of its bag with the word it hides.  Subwords
are hashed into `2**BITS` rows of an embedding table.  The text's vector is their average,
each weighted by its inverse document frequency; a linear layer with softmax gives the two
classes, and table and layer are trained together by gradient descent with momentum.  All subwords
of the sample are learned; what few texts hold is mostly chance, so a weight is shrunk by
n / (n + `DOUBT`), n being the number of the sample's texts that hold the subword.

*Fit.*  Labels of at most `POSITIVE` toxic and `NEGATIVE` clean texts (documented bounds, drawn
by hash) are learned from; their bags are made by Spark from whole texts, and the small model is
trained in numpy by one task.  The loss weighs the classes as they occur among all labels.

*Score.*  Averaging and the linear layer commute, so the trained model folds into one number
per table row; a text's logit is the mean of its subwords' numbers plus the bias.

Nulls: a null or empty text has no subwords and gets the score of the bias alone.  A row without
id, or a label that is null, is not learned from; an id labelled twice counts as toxic if any of
its labels says so.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .sampling import drawn
from .store import doc_field, packed, unpacked

BITS = 18
SIZES = (3, 4, 5, 6, 7)
WIDTH = 4
POSITIVE, NEGATIVE = 1500, 3000
DOUBT = 5
STEPS, BATCH, RATE, MOMENTUM = 300, 128, 0.5, 0.9
# averages of rare subwords are small numbers; this brings them near one
_GAIN = 100.0
# subwords of a text are several arrays of its length: small blocks bound what a task holds
_BLOCK = 1 << 18
# the bias where all labels are alike
_ONE_CLASS = 4.0


class Model(NamedTuple):
    """What one subword of each table row adds to the logit, and the bias."""

    weight: np.ndarray
    bias: float


def _subwords(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all subwords of a block, text by text, and where each text begins."""
    found = scan.words(data, off, scan.ALPHANUMERIC)
    sizes = found.stop - found.start
    # words laid side by side, each between two marks
    begin = np.cumsum(sizes + 2) - (sizes + 2)
    total = int((sizes + 2).sum())
    text = np.full(total, 0x3C, np.uint64)
    letters = np.arange(int(sizes.sum()))
    place = letters + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
    text[place] = scan.LOWER[data[letters + np.repeat(found.start - (np.cumsum(sizes) - sizes), sizes)]]
    text[begin + sizes + 1] = 0x3E
    end = np.repeat(begin + sizes + 2, sizes + 2)
    at = np.arange(total)
    rows, owner = [], []
    of_byte = np.repeat(scan.owners(found.first), sizes + 2)
    gram = text.copy()
    for size in range(2, max(SIZES) + 1):
        gram = gram[: max(total - size + 1, 0)] | (text[size - 1 :] << np.uint64(8 * (size - 1)))
        if size in SIZES:
            fits = np.flatnonzero(at[: len(gram)] + size <= end[: len(gram)])
            rows.append(scan.mix(gram[fits] + np.uint64(size << 56)) >> np.uint64(64 - BITS))
            owner.append(of_byte[fits])
    rows.append(scan.word_hashes(data, found, fold=True) >> np.uint64(64 - BITS))
    owner.append(scan.owners(found.first))
    return np.concatenate(rows).astype(np.int64), np.concatenate(owner)


def _bags(batches):
    """Per text its table rows and how often each occurs, as byte strings."""
    for batch in batches:
        for low, high, data, off in scan.blocks(batch.column("_text"), _BLOCK):
            rows, owner = _subwords(data, off)
            keys, n = np.unique((owner << BITS) | rows, return_counts=True)
            cuts = np.searchsorted(keys >> BITS, np.arange(1, high - low))
            keys = (keys & ((1 << BITS) - 1)).astype("<u4")
            columns = [
                batch.column("toxic").slice(low, high - low),
                pa.array([x.tobytes() for x in np.split(keys, cuts)], pa.binary()),
                pa.array([x.tobytes() for x in np.split(n.astype("<u4"), cuts)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "rows", "n"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    positive: int = POSITIVE,
    negative: int = NEGATIVE,
    seed: int = 7,
) -> Model:
    """Trains on the labelled rows of `docs`; the caller leaves out what is held out."""
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id")).agg(F.max(F.col(label_column).cast("int")).alias("toxic"))
        .where("toxic in (0, 1)")
    )
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).where("_text is not null")
    there = known.join(texts.select("_id").distinct(), "_id", "left_semi")
    total = {r.toxic: r.n for r in there.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        drawn(there.where(F.col("toxic") == kind), "_id", wanted, total.get(kind, 0), seed)
        for kind, wanted in ((1, positive), (0, negative))
    ]
    # at most `positive + negative` ids
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    sample = texts.join(chosen, "_id").select("toxic", "_text")
    share = total.get(1, 0) / max(sum(total.values()), 1)
    bags = sample.mapInArrow(_bags, "toxic int, rows binary, n binary")
    # the sample is bounded, so one task holds its bags
    trained = bags.repartition(1).mapInArrow(_trained(share, seed), "weight binary, bias double").collect()
    if not trained:
        return train([], [], np.zeros(0, np.int64), 0.0, seed)
    return Model(np.frombuffer(trained[0].weight, np.float32), trained[0].bias)


def _trained(share: float, seed: int):
    def task(batches):
        rows, counts, toxic = [], [], []
        for batch in batches:
            for bag in batch.to_pylist():
                rows.append(np.frombuffer(bag["rows"], "<u4"))
                counts.append(np.frombuffer(bag["n"], "<u4"))
                toxic.append(bag["toxic"])
        model = train(rows, counts, np.array(toxic, np.int64), share, seed)
        columns = [pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])]
        yield pa.RecordBatch.from_arrays(columns, names=["weight", "bias"])

    return task


def _raw(values: np.ndarray) -> bytes:
    """The bytes of an array, those it was read from where it is a view of them."""
    return values.base if isinstance(values.base, bytes) else values.tobytes()


def train(rows: list, counts: list, toxic: np.ndarray, share: float, seed: int = 7) -> Model:
    """Descends on embeddings and linear layer together; deterministic for a given set of bags."""
    order = sorted(range(len(rows)), key=lambda i: (toxic[i], _raw(rows[i]), _raw(counts[i])))
    rows, counts, toxic = [rows[i] for i in order], [counts[i] for i in order], toxic[order]
    weight = np.zeros(1 << BITS, np.float32)
    if not len(rows) or toxic.min() == toxic.max():
        return Model(weight, _ONE_CLASS if len(rows) and toxic[0] else -_ONE_CLASS)
    held = np.zeros(1 << BITS, np.int64)
    for r in rows:
        held[r] += 1  # a bag holds a subword once
    used = np.flatnonzero(held)
    rarity = np.log(len(rows) / held[used]) * (held[used] / (held[used] + DOUBT))
    slot = np.full(1 << BITS, -1, np.int32)
    slot[used] = np.arange(len(used))
    bags = []
    for i in range(len(rows)):
        r, n = rows[i], counts[i]
        rows[i] = counts[i] = None  # the bags take their place
        at = slot[r]
        bags.append((at, (n * (_GAIN / max(n.sum(), 1)) * rarity[at]).astype(np.float32)))
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.001, (len(used), WIDTH)).astype(np.float32)
    layer = np.tile(np.array([-0.3, 0.3], np.float32), (WIDTH, 1))
    bias = np.zeros(2, np.float32)
    # table and layer grow together; the layer, which all subwords share, takes smaller steps
    params, rates = [table, layer, bias], [RATE, RATE / 10, RATE / 10]
    pace = [np.zeros_like(p) for p in params]
    class_weight = np.array([1 - share, share]) / (np.bincount(toxic, minlength=2) / len(toxic))
    # a step takes the next bags of a shuffled round; small samples go round more often
    queue = np.zeros(0, np.int64)
    for _ in range(STEPS):
        if len(queue) < min(BATCH, len(bags)):
            queue = random.permutation(len(bags))
        chosen, queue = queue[:BATCH], queue[BATCH:]
        at = np.concatenate([bags[i][0] for i in chosen])
        x = np.concatenate([bags[i][1] for i in chosen])
        of = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
        hidden = np.stack([np.bincount(of, table[at, d] * x, len(chosen)) for d in range(WIDTH)], axis=1)
        logits = hidden @ layer + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        miss = odds / odds.sum(axis=1, keepdims=True)
        miss[np.arange(len(chosen)), toxic[chosen]] -= 1
        miss *= class_weight[toxic[chosen], None] / len(chosen)
        back = miss @ layer.T
        slopes = [
            np.stack([np.bincount(at, back[of, d] * x, len(used)) for d in range(WIDTH)], axis=1),
            hidden.T @ miss,
            miss.sum(axis=0),
        ]
        for p, v, g, rate in zip(params, pace, slopes, rates):
            v *= MOMENTUM
            v += g
            p -= rate * v
    weight[used] = _GAIN * rarity * (table @ (layer[:, 1] - layer[:, 0]))
    return Model(weight, float(bias[1] - bias[0]))


def _score(shared):
    def task(batches):
        model = Model(*shared.value)
        for batch in batches:
            logits = []
            for low, high, data, off in scan.blocks(batch.column("_text"), _BLOCK):
                rows, owner = _subwords(data, off)
                n = np.bincount(owner, minlength=high - low)
                total = np.bincount(owner, model.weight[rows], high - low)
                logits.append(total / np.maximum(n, 1) + model.bias)
            z = np.clip(np.concatenate(logits) if logits else np.zeros(0), -500, 500)
            columns = [batch.column("_doc"), pa.array(1 / (1 + np.exp(-z)))]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", "score"])

    return task


def score(docs: DataFrame, model: Model, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `carry`) with `score`, the chance of being toxic; a column of that name is replaced."""
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    rows = packed(docs).select(
        F.struct(*[doc_field(c).alias(c) for c in wanted.columns]).alias("_doc"), doc_field(text_column).alias("_text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    scored = rows.mapInArrow(_score(shared), rows.select("_doc").schema.add("score", "double"))
    return unpacked(scored, wanted, "score")
