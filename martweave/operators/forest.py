"""Isolation forest (Liu, Ting and Zhou, ICDM 2008): fit per tree, score per batch.

Spark draws the samples and spreads trees and rows over tasks; a tree sees at most
`sample_size` rows, and the fitted model is a table of at most 2 * sample_size - 1 nodes
per tree.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..session import pin
from .quantile import exact_quantile

# task code travels with the job, so workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, below int, above int, path double, sample int"
)
# over-sampling factor: the chance that a tree draws fewer than sample_size rows is negligible
_SPARE = 3
_HASH_SPACE = 1 << 40


def usable_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows all of whose features could be computed."""
    test = F.lit(True)
    for name in features:
        test = test & F.col(name).isNotNull()
    return df.filter(test)


def training_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: how many rows can train and how many are skipped."""
    return df.agg(
        F.count_if(F.greatest(*[F.col(f).isNull() for f in features])).alias("skipped_rows"),
        F.count(F.lit(1)).alias("all_rows"),
    ).select((F.col("all_rows") - F.col("skipped_rows")).alias("usable_rows"), "skipped_rows")


def tree_samples(
    df: DataFrame, key: str, features: Sequence[str], trees: int, sample_size: int, seed: int, total: int
) -> DataFrame:
    """At most `sample_size` rows per tree, drawn by hash so that a rerun draws the same.

    Every (row, tree) is drawn on its own, at any size of the table; `total` is the number of
    rows of `df`, all of which must be usable.
    """
    columns = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.select(F.col(key).alias("_key"), *columns)
    share = min(1.0, _SPARE * sample_size / max(total, 1))
    limit = F.lit(int(share * _HASH_SPACE))
    key_hash = F.xxhash64(F.col("_key"), F.lit(seed))
    chosen = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(key_hash, t), F.lit(_HASH_SPACE)) < limit,
    )
    drawn = rows.withColumn("tree", F.explode(chosen))
    order = Window.partitionBy("tree").orderBy(F.xxhash64("_key", "tree", F.lit(seed + 1)), "_key")
    return drawn.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample_size).drop("_r")


def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    result = np.zeros_like(n)
    result[n == 2] = 1.0
    more = n > 2
    m = n[more]
    result[more] = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return result


def _grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes of one tree as (node, feature, threshold, below, above, path); feature -1 is a leaf."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list = [None]
    todo = [(0, points, 0)]
    while todo:
        node, part, depth = todo.pop()
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        splittable = np.flatnonzero(high > low) if len(part) > 1 else []
        if depth >= limit or len(splittable) == 0:
            path = depth + float(average_path([len(part)])[0])
            nodes[node] = (node, -1, 0.0, node, node, path)
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        is_below = part[:, feature] <= threshold
        below, above = len(nodes), len(nodes) + 1
        nodes.extend([None, None])
        nodes[node] = (node, feature, threshold, below, above, 0.0)
        todo.append((above, part[~is_below], depth + 1))
        todo.append((below, part[is_below], depth + 1))
    return nodes


def fit(
    df: DataFrame,
    key: str,
    features: Sequence[str] = tuple(V.FEATURE_NAMES),
    trees: int = V.FOREST_TREES,
    sample_size: int = V.FOREST_SAMPLE,
    seed: int = V.FOREST_SEED,
) -> DataFrame:
    """Node table of the fitted forest."""
    names = list(features)
    usable = usable_rows(df, names)
    total = usable.count()
    samples = tree_samples(usable, key, names, trees, sample_size, seed, total)
    full = min(sample_size, total)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < full:
            raise ValueError(f"a tree drew {len(pdf)} rows though {total} are usable")
        pdf = pdf.sort_values("_key", kind="stable")
        tree = int(pdf["tree"].iloc[0])
        grown = _grow(pdf[names].to_numpy(dtype=float), np.random.default_rng([seed, tree]))
        table = pd.DataFrame(grown, columns=["node", "feature", "threshold", "below", "above", "path"])
        return table.assign(tree=tree, sample=len(pdf))[
            ["tree", "node", "feature", "threshold", "below", "above", "path", "sample"]
        ]

    return samples.groupBy("tree").applyInPandas(build, NODE_SCHEMA)


def save(nodes: DataFrame, path: str) -> None:
    nodes.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark, path: str) -> DataFrame:
    return spark.read.schema(NODE_SCHEMA).parquet(path)


def _packed(nodes: DataFrame, trees: int, sample_size: int) -> dict[str, np.ndarray]:
    """Model as arrays.  The table is bounded by trees * (2 * sample_size - 1) rows; more is refused."""
    bound = trees * (2 * sample_size - 1)
    table = nodes.limit(bound + 1).toPandas()
    if len(table) > bound:
        raise ValueError(f"model has more than {bound} nodes")
    if table.empty:
        raise ValueError("model has no nodes")
    ids = {t: i for i, t in enumerate(sorted(table["tree"].unique()))}
    at = table["tree"].map(ids).to_numpy()
    node = table["node"].to_numpy()
    shape = (len(ids), int(node.max()) + 1)
    packed = {}
    for name, kind in [("feature", int), ("threshold", float), ("below", int), ("above", int), ("path", float)]:
        packed[name] = np.zeros(shape, dtype=kind)
        packed[name][at, node] = table[name].to_numpy()
    packed["scale"] = average_path([max(int(table["sample"].max()), 2)])
    packed["depth"] = np.array([int(np.ceil(np.log2(max(table["sample"].max(), 2))))])
    return packed


def raw_scores(model: dict[str, np.ndarray], points: np.ndarray) -> np.ndarray:
    """Scores in [-1, 0), lower being more unusual; all rows walk one level of all trees at a time."""
    trees, width = model["feature"].shape
    flat = {name: model[name].ravel() for name in ("feature", "threshold", "below", "above", "path")}
    base = (np.arange(trees, dtype=np.int64) * width)[None, :]
    row = (np.arange(len(points), dtype=np.int64) * points.shape[1])[:, None]
    values = np.ascontiguousarray(points).ravel()
    at = np.broadcast_to(base, (len(points), trees))
    for _ in range(int(model["depth"][0])):
        # a leaf points to itself on both sides, whatever the comparison says
        feature = np.maximum(flat["feature"].take(at), 0)
        goes_below = values.take(row + feature) <= flat["threshold"].take(at)
        at = base + np.where(goes_below, flat["below"].take(at), flat["above"].take(at))
    mean_path = flat["path"].take(at).mean(axis=1)
    return -np.power(2.0, -mean_path / model["scale"][0])


def shared_model(nodes: DataFrame, trees: int = V.FOREST_TREES, sample_size: int = V.FOREST_SAMPLE) -> Broadcast:
    """The model packed and broadcast once, for callers that score many batches."""
    return nodes.sparkSession.sparkContext.broadcast(_packed(nodes, trees, sample_size))


def with_raw_score(
    df: DataFrame,
    nodes: DataFrame | Broadcast,
    features: Sequence[str] = tuple(V.FEATURE_NAMES),
    name: str = "ml_raw_score",
    trees: int = V.FOREST_TREES,
    sample_size: int = V.FOREST_SAMPLE,
) -> DataFrame:
    """Adds the raw score; null where a feature is missing.  `nodes`: the node table or `shared_model` of it."""
    model = nodes if isinstance(nodes, Broadcast) else shared_model(nodes, trees, sample_size)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
        known = ~np.isnan(points).any(axis=1)
        result = np.full(len(points), np.nan)
        # bounded working set: rows x trees integers per level
        for start in range(0, len(points), 1024):
            part = slice(start, start + 1024)
            chosen = np.flatnonzero(known[part]) + start
            if len(chosen):
                result[chosen] = raw_scores(model.value, points[chosen])
        return pd.Series(result).where(known)

    return df.withColumn(name, score(*[F.col(f).cast("double") for f in features]))


def threshold(scored: DataFrame, score: str = "ml_raw_score", contamination: float = V.FOREST_CONTAMINATION) -> float:
    """Score below which the share `contamination` of the training rows lies, exactly.

    The scores are written once and counted digit by digit; no task sees them all.
    """
    cut = exact_quantile(pin(scored.select(score), "scores"), score, contamination)
    if cut is None:
        raise ValueError("no scored rows")
    return cut


def with_prediction(scored: DataFrame, cut: float, score: str = "ml_raw_score") -> DataFrame:
    """1 for normal, -1 for unusual."""
    return scored.withColumn("prediction", F.when(F.col(score) < cut, F.lit(-1)).otherwise(F.lit(1)))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class (0 normal, 1 anomaly); undefined ratios are 0."""
    names = F.array(
        *[
            F.struct(F.lit(value).alias("value"), F.lit(name).alias("class"))
            for value, name in [(0, "normal"), (1, "anomaly")]
        ]
    )
    cells = df.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))
    per_class = cells.select(F.inline(names), label, predicted, "n").groupBy("class").agg(
        *[
            F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias(name)
            for name, test in {
                "hits": (F.col(label) == F.col("value")) & (F.col(predicted) == F.col("value")),
                "chosen": F.col(predicted) == F.col("value"),
                "support": F.col(label) == F.col("value"),
            }.items()
        ]
    )

    def zero_ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    precision, recall = zero_ratio(F.col("hits"), F.col("chosen")), zero_ratio(F.col("hits"), F.col("support"))
    return per_class.select(
        "class",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(zero_ratio(2 * precision * recall, precision + recall), 6).alias("f1"),
        "support",
    )


def mean_score_per_label(df: DataFrame, label: str, score: str = "ml_raw_score") -> DataFrame:
    return df.groupBy(label).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("rows"))
