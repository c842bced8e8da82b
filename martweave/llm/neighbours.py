"""Approximate nearest neighbours: a forest of random-projection trees, exactly reranked.

*Fit.*  Each level of a tree projects on one random direction and halves every node at the
median of its sample rows.  The sample is bounded (`SAMPLE` rows, drawn by hash); thresholds
for a tree are at most as many as sample rows.  How much of the forest must be searched for
`recall` is read off the sample: its own queries are searched in it against brute force.

*Index.*  Every row goes to one leaf per tree.  Leaf sizes are counted; a leaf larger than
`PART` (many equal vectors) is dealt out over several units.

*Search.*  Each query keeps one priority queue over all trees, ordered by the squared distance
to the splits crossed so far, and opens leaves until the fitted share of all leaf rows is
reached.  Rows and queries meet by leaf; a unit measures its rows in double precision and a
task keeps the best of each query, so few rows leave it.

Vectors that are null, all zero or hold a null, NaN or infinite component take no part, nor do
vectors whose length is not the most frequent one (the longer of equally frequent ones) or rows
without id.  A query is not its own neighbour: rows of its id are left out.  Equal distances go
to the smaller id.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import drawn

TREES = 6
LEAF = 64
SAMPLE = 16_384
SAMPLE_QUERIES = 256
RECALL = 0.98
PART = 4096
_HELD_QUERIES = 1 << 15
# of a squared distance from norms and products: per component, relative to the squared norms
_ROUNDING = 8 * np.finfo(np.float64).eps


class Forest(NamedTuple):
    """`directions[t, level]`; `thresholds[level][t, node]`; `share`: of all leaf rows to search."""

    directions: np.ndarray
    thresholds: list[np.ndarray]
    share: float


def usable(vector: Column, size: int | None = None) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    test = vector.isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0)
    return test if size is None else test & (F.size(vector) == size)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), size)


def _leaves(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector in each tree."""
    trees, depth, size = forest.directions.shape
    spots = (vectors @ forest.directions.reshape(-1, size).T).reshape(len(vectors), trees, depth)
    node = np.zeros((len(vectors), trees), np.int64)
    each = np.arange(trees)
    for level in range(depth):
        node = node * 2 + (spots[:, :, level] >= forest.thresholds[level][each, node])
    return node


def plant(sample: np.ndarray, rows: int, trees: int, leaf: int, recall: float, k: int, seed: int) -> Forest:
    """The forest for a table of `rows` vectors like those of `sample`."""
    random = np.random.default_rng(seed)
    most = int(np.log2(max(len(sample), 1)))
    depth = min(most, max(0, int(np.ceil(np.log2(max(rows, 1) / leaf)))))
    size = sample.shape[1]
    directions = random.normal(size=(trees, depth, size))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    thresholds = [np.zeros((trees, 1 << level)) for level in range(depth)]
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            spot = sample @ directions[t, level]
            order = np.lexsort((spot, node))
            count = np.bincount(node, minlength=1 << level)
            begin = np.cumsum(count) - count
            middle = spot[order[np.minimum(begin + count // 2, len(sample) - 1)]]
            # a node that no sample row reaches (equal rows) is cut where its last row would be
            thresholds[level][t] = middle
            node = node * 2 + (spot >= middle[node])
    forest = Forest(directions, thresholds, 1.0)
    return forest._replace(share=_needed_share(forest, sample, recall, k)) if depth else forest


def _needed_share(forest: Forest, sample: np.ndarray, recall: float, k: int) -> float:
    """The share of leaf rows after which `recall` of the sample's true neighbours were met."""
    trees, depth, size = forest.directions.shape
    leaves = _leaves(forest, sample)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=1 << depth) for t in range(trees)])
    queries = sample[:: max(1, len(sample) // SAMPLE_QUERIES)]
    square = (sample**2).sum(axis=1)
    needed = []
    for nth, query in enumerate(queries):
        far = square - 2 * (sample @ query)
        far[nth * max(1, len(sample) // SAMPLE_QUERIES)] = np.inf
        true = np.argsort(far, kind="stable")[:k]
        costs = np.zeros((trees, 1))
        for level in range(depth):
            margin = (forest.directions[:, level] @ query)[:, None] - forest.thresholds[level]
            below = costs + np.where(margin >= 0, margin**2, 0)
            above = costs + np.where(margin < 0, margin**2, 0)
            costs = np.stack([below, above], axis=2).reshape(trees, -1)
        order = np.argsort(costs.ravel(), kind="stable")
        opened = np.empty(costs.size)
        opened[order] = np.cumsum(sizes.ravel()[order])
        at = np.arange(trees) * costs.shape[1] + leaves[true]
        needed.append(opened[at].min(axis=1) / (trees * len(sample)))
    return float(np.quantile(np.concatenate(needed), recall)) if needed else 1.0


def open_leaves(forest: Forest, sizes: np.ndarray, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one queue over all trees, until enough rows are opened.

    A row is met at most once per tree, so `trees * (k + 1)` rows hold k besides the query.
    """
    trees, depth, _ = forest.directions.shape
    spots = (forest.directions @ query).tolist()
    thresholds, got = forest.thresholds, 0
    limit = max(forest.share * sizes.sum(), trees * (k + 1))
    queue = [(0.0, t, 0, 0) for t in range(trees)]
    opened = []
    while queue and (got < limit or not opened):
        cost, t, level, node = heapq.heappop(queue)
        while level < depth:
            margin = spots[t][level] - thresholds[level][t, node]
            node *= 2
            near, other = (node + 1, node) if margin >= 0 else (node, node + 1)
            heapq.heappush(queue, (cost + margin * margin, t, level + 1, other))
            node, level = near, level + 1
        if sizes[t, node]:
            opened.append((t, node))
            got += sizes[t, node]
    return opened


def _counted(shared, size: int):
    def task(batches):
        forest = Forest(*shared.value)
        trees, depth, _ = forest.directions.shape
        total = np.zeros((trees, 1 << depth), np.int64)
        for batch in batches:
            leaves = _leaves(forest, _matrix(batch.column("_vector"), size))
            for t in range(trees):
                total[t] += np.bincount(leaves[:, t], minlength=1 << depth)
        t, leaf = np.nonzero(total)
        rows = [t.astype(np.int32), leaf, total[t, leaf]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["tree", "leaf", "n"])

    return task


def _units(parts: np.ndarray, t, leaf, part) -> np.ndarray:
    """A number for each (tree, leaf, part): parts of a leaf are numbered side by side."""
    begin = (np.cumsum(parts) - parts.ravel()).reshape(parts.shape)
    return begin[t, leaf] + part


def _placed(shared, size: int, k: int):
    """Rows go to one unit per tree, queries to all parts of the leaves they open."""

    def task(batches):
        planted, sizes, parts = shared.value
        forest = Forest(*planted)
        trees = len(forest.directions)
        for batch in batches:
            ids = np.asarray(batch.column("_id"))
            asks = np.asarray(batch.column("_query").cast(pa.int8())) == 1
            vectors = _matrix(batch.column("_vector"), size)
            leaves = _leaves(forest, vectors)
            for t in range(trees):
                salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                part = salt % parts[t, leaves[:, t]].astype(np.uint64)
                units = _units(parts, t, leaves[:, t], part.astype(np.int64))
                yield _routed(units, np.zeros(len(ids), np.int8), ids, vectors)
            for i in np.flatnonzero(asks):
                t, leaf = np.array(open_leaves(forest, sizes, vectors[i], k)).T
                n = parts[t, leaf]
                units = np.repeat(_units(parts, t, leaf, 0), n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                yield _routed(units, np.ones(len(units), np.int8), np.full(len(units), ids[i]), vectors[[i] * len(units)])

    return task


def _routed(units, kind, ids, vectors) -> pa.RecordBatch:
    offsets = np.arange(len(ids) + 1, dtype=np.int32) * vectors.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
    columns = [pa.array(units), pa.array(kind), pa.array(ids), lists]
    return pa.RecordBatch.from_arrays(columns, names=["_unit", "_kind", "_id", "_vector"])


def nearest(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, rough: np.ndarray, slack: float, k: int):
    """(distance, id) of the k nearest rows; `rough` are squared distances good to `slack`, or not finite."""
    other = ids != own
    if not other.any():
        return []
    # what overflows is near until the exact distance says otherwise
    sure = np.isfinite(rough) & other
    last = np.partition(rough[sure], k - 1)[k - 1] if sure.sum() > k and np.isfinite(slack) else np.inf
    near = np.flatnonzero(other & ~(sure & (rough > last + 2 * slack)))
    exact = _distances(vectors[near], query)
    order = np.lexsort((ids[near], exact))[:k]
    return list(zip(exact[order].tolist(), ids[near][order].tolist()))


def _distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact distances; rows whose squares overflow are measured in units of their largest difference."""
    with np.errstate(over="ignore", invalid="ignore"):
        apart = vectors - query
        exact = np.sqrt((apart**2).sum(axis=1))
        far = np.flatnonzero(~np.isfinite(exact))
        if len(far):
            # halves cannot overflow in the difference
            half = vectors[far] / 2 - query / 2
            unit = np.abs(half).max(axis=1)
            exact[far] = np.sqrt(((half / unit[:, None]) ** 2).sum(axis=1)) * unit * 2
    return exact


def _measured(size: int, k: int):
    """Units arrive sorted, rows before queries; keeps the best k of each query in the task."""

    def task(batches):
        best: dict[int, list] = {}
        unit, ids, vectors, square = None, [], [], None
        for batch in batches:
            all_units = np.asarray(batch.column("_unit"))
            kinds = np.asarray(batch.column("_kind"))
            all_ids = np.asarray(batch.column("_id"))
            matrix = _matrix(batch.column("_vector"), size)
            cuts = np.flatnonzero((np.diff(all_units) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(kinds)]):
                if all_units[low] != unit:
                    unit, ids, vectors, square = all_units[low], [], [], None
                if kinds[low] == 0:
                    ids.append(all_ids[low:high])
                    vectors.append(matrix[low:high])
                    continue
                if not ids:
                    continue
                if square is None:
                    here, rows = np.concatenate(ids), np.concatenate(vectors)
                    square = (rows**2).sum(axis=1)
                asked = matrix[low:high]
                with np.errstate(over="ignore", invalid="ignore"):
                    norms = (asked**2).sum(axis=1)
                    rough = square - 2 * (asked @ rows.T) + norms[:, None]
                    slack = _ROUNDING * size * (norms + square.max())
                for n in range(high - low):
                    own = int(all_ids[low + n])
                    found = nearest(asked[n], own, here, rows, rough[n], slack[n], k)
                    best[own] = sorted({*best.get(own, ()), *found}, key=lambda x: (x[0], x[1]))[:k]
                if len(best) >= _HELD_QUERIES:
                    yield _answers(best)
                    best = {}
        yield _answers(best)

    return task


def _answers(best: dict) -> pa.RecordBatch:
    flat = [(q, i, d) for q, found in best.items() for d, i in found]
    kinds = [pa.int64(), pa.int64(), pa.float64()]
    columns = [pa.array([r[n] for r in flat], t) for n, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    recall: float = RECALL,
    seed: int = 11,
) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): the k nearest rows found for each row where `is_query`."""
    spark = vectors.sparkSession
    every = vectors.select(
        F.col(id_column).cast("long").alias("_id"),
        F.coalesce(is_query, F.lit(False)).alias("_query"),
        F.col(vector_column).cast("array<double>").alias("_vector"),
    ).where(F.col("_id").isNotNull() & usable(F.col("_vector")))
    lengths = every.groupBy(F.size("_vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    size, rows = common
    every = every.where(F.size("_vector") == size)
    some = drawn(every, "_id", sample, rows, seed).select("_vector").toArrow()
    forest = plant(_matrix(some.column(0).combine_chunks(), size), rows, trees, leaf, recall, k, seed)
    shared = spark.sparkContext.broadcast(tuple(forest))
    counts = every.mapInArrow(_counted(shared, size), "tree int, leaf long, n long")
    sizes = np.zeros((trees, 1 << forest.directions.shape[1]), np.int64)
    # at most one row per leaf of the forest
    for t, node, n in counts.groupBy("tree", "leaf").agg(F.sum("n")).collect():
        sizes[t, node] = n
    index = spark.sparkContext.broadcast((tuple(forest), sizes, np.maximum(1, -(-sizes // PART))))
    placed = every.mapInArrow(_placed(index, size, k), "_unit long, _kind tinyint, _id long, _vector array<double>")
    met = placed.repartition("_unit").sortWithinPartitions("_unit", "_kind")
    found = met.mapInArrow(_measured(size, k), "query_id long, vec_id long, score double")
    by_nearness = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (
        once.withColumn("rank", F.row_number().over(by_nearness)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
