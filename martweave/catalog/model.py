"""Registered model queries.  A fitted forest has no SQL equivalent; its shape and a given forest's scores have."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.risk import with_features
from ..operators import forest
from ..operators.forest import average_path
from ..operators.quantile import exact_quantile
from ..plans import spend as P
from ..session import pin
from ..streaming.spend import scored
from . import spend
from .common import Catalog, plain, rounded
from .standins import TRANSACTIONS

catalog = Catalog()


def fitted(spark, folder):
    """Forest fitted on all transactions; the node table is written once and read by all scorers."""
    features = P.transaction_features(spend.transactions(spark, folder))
    return pin(forest.fit(features, "transaction_id"), "forest")


@catalog.add("iforest_scores")
def _(spark, folder):
    """All transactions scored by the fitted forest, with rules and combined risk."""
    nodes = fitted(spark, folder)
    rows = scored(spend.transactions(spark, folder).drop("ml_raw_score", "event_id", "ts"), nodes)
    columns = [
        "transaction_id",
        "ml_raw_score",
        "ml_anomaly_score",
        "rule_flag_count",
        "rule_contribution",
        "final_risk_score",
        "risk_flag",
    ]
    return plain(rows.select(*columns))


@catalog.add(
    "iforest_nodes",
    f"""select unnest(range({V.FOREST_TREES})) tree, least(count(*), {V.FOREST_SAMPLE}) sample, true twice_the_leaves_less_one,
    true within_depth, true every_node_once from {TRANSACTIONS.sql}""",
)
def _(spark, folder):
    """What must hold of every fitted tree: its sample, a full binary shape, its depth, no node missing."""
    nodes = fitted(spark, folder)
    depth = math.ceil(math.log2(V.FOREST_SAMPLE))
    return plain(
        nodes.groupBy("tree").agg(
            F.max("sample").alias("sample"),
            (F.count(F.lit(1)) == 2 * F.count_if(F.col("feature") == -1) - 1).alias("twice_the_leaves_less_one"),
            # the path of a leaf holds its depth and, for several rows, the mean search path below it
            (F.min(F.when(F.col("feature") == -1, F.col("path"))) <= depth).alias("within_depth"),
            ((F.count_distinct("node") == F.count(F.lit(1))) & (F.max("node") == F.count(F.lit(1)) - 1)).alias("every_node_once"),
        )
    )


# two small trees that SQL can walk: (tree, node, feature, threshold, below, above, path)
_NODES = [
    (0, 0, 0, 2500.0, 1, 2, 0.0),
    (0, 1, 3, 11.5, 3, 4, 0.0),
    (0, 2, -1, 0.0, 2, 2, 1.0),
    (0, 3, -1, 0.0, 3, 3, 2.0),
    (0, 4, -1, 0.0, 4, 4, 3.5),
    (1, 0, 4, 3.5, 1, 2, 0.0),
    (1, 1, -1, 0.0, 1, 1, 4.25),
    (1, 2, 7, 1.5, 3, 4, 0.0),
    (1, 3, -1, 0.0, 3, 3, 2.5),
    (1, 4, -1, 0.0, 4, 4, 5.0),
]
_WALK_ROWS = 16


def walk_sql(source: str) -> str:
    """SQL of (transaction_id, raw) for `source`(transaction_id, v): its features walked down the given trees."""
    return f"""(with recursive nodes(tree, node, feature, threshold, below, above, path) as (values {", ".join(map(str, _NODES))}),
    x as (select * from {source}),
    walk as (select transaction_id, v, tree, 0 node from x, (values (0), (1)) t(tree)
      union all select transaction_id, v, w.tree, if(v[n.feature + 1] <= n.threshold, n.below, n.above)
      from walk w join nodes n on n.tree = w.tree and n.node = w.node where n.feature >= 0)
    select transaction_id, -pow(2.0, -avg(path) / {float(average_path([_WALK_ROWS])[0])!r}) raw
    from walk w join nodes n on n.tree = w.tree and n.node = w.node where n.feature = -1 group by transaction_id)"""


def given_forest(spark):
    return spark.createDataFrame([(*n, _WALK_ROWS) for n in _NODES], forest.NODE_SCHEMA)


_FEATURE_LIST = f"(select transaction_id, [{', '.join(V.FEATURE_NAMES)}] v from ({spend.catalog.checks['features']}))"


@catalog.add("forest_walk", f"select transaction_id, {rounded('raw', 9)} ml_raw_score from {walk_sql(_FEATURE_LIST)}")
def _(spark, folder):
    """All transactions scored by a given forest."""
    features = P.transaction_features(spend.transactions(spark, folder))
    scores = forest.with_raw_score(features, given_forest(spark))
    return plain(scores.select("transaction_id", "ml_raw_score"), {"ml_raw_score": 9})


_MEASURES = ("ml_raw_score", "log_amount", "amount_to_baseline_ratio")
_MEASURED_SQL = f"""(select raw ml_raw_score, v[3] log_amount, v[2] amount_to_baseline_ratio
    from {walk_sql(_FEATURE_LIST)} join {_FEATURE_LIST} using (transaction_id))"""


@catalog.add(
    "forest_cuts",
    " union all ".join(
        f"select '{m}' measure, {rounded(f'quantile_cont({m}, {V.FOREST_CONTAMINATION})', 9)} cut, count({m}) counted from {_MEASURED_SQL}"
        for m in _MEASURES
    ),
)
def _(spark, folder):
    """The exact cut for the expected share of unusual rows, of a given forest's scores and of two features."""
    features = P.transaction_features(spend.transactions(spark, folder))
    scores = pin(forest.with_raw_score(features, given_forest(spark)).select(*_MEASURES), "scores")
    cuts = [(m, exact_quantile(scores, m, V.FOREST_CONTAMINATION)) for m in _MEASURES]
    counts = scores.select(F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in _MEASURES])))
    counts = counts.groupBy("measure").agg(F.count("value").alias("counted"))
    return plain(spark.createDataFrame(cuts, "measure string, cut double").join(counts, "measure"), {"cut": 9})


def _evaluated(spark, folder, nodes=None):
    nodes = fitted(spark, folder) if nodes is None else nodes
    rows = spend.transactions(spark, folder)
    known = forest.with_raw_score(P.transaction_features(rows), nodes)
    cut = forest.threshold(known)
    sample = P.evaluation_set(rows, spend._draw(17), F.col("event_id") % 3, spend.SUNDAY_NIGHT)
    features = with_features(sample)
    judged = forest.with_prediction(forest.with_raw_score(features, nodes), cut)
    return judged.withColumn("predicted", (F.col("prediction") == -1).cast("int"))


@catalog.add("iforest_report")
def _(spark, folder):
    return plain(forest.classification_report(_evaluated(spark, folder), "label", "predicted"))


@catalog.add("iforest_mean_scores")
def _(spark, folder):
    return plain(forest.mean_score_per_label(_evaluated(spark, folder), "label"))


# the evaluation rows with what the features need; the first rows may be among the last as well
_EVALUATION_SQL = f"""(with d as (select *, {spend._ORDER_SQL} o from {TRANSACTIONS.sql}),
    ranked as (select *, row_number() over (order by o, transaction_id) up, row_number() over (order by o desc, transaction_id) down from d)
    select 'n' || transaction_id transaction_id, 0::bigint as label, ts, amount_usd, baseline_monthly_spend, vendor_risk_tier, vendor_category
    from ranked where up <= 200
    union all select 'u' || transaction_id, 1, if(event_id % 3 = 1, timestamp '{spend.SUNDAY_NIGHT[:19]}', ts),
    case event_id % 3 when 0 then amount_usd * 15 when 1 then amount_usd * 8 else baseline_monthly_spend end,
    baseline_monthly_spend, vendor_risk_tier, vendor_category from ranked where down <= 50)"""
_EVALUATION_LIST = f"""(select transaction_id, [amount_usd, if(baseline_monthly_spend > 0, amount_usd / nullif(baseline_monthly_spend, 0), 0.0),
    ln(1 + amount_usd), hour(ts), isodow(ts) - 1, (isodow(ts) >= 6)::int, (vendor_risk_tier = 'high')::int,
    coalesce(nullif(list_position({V.VENDOR_CATEGORIES}, vendor_category), 0) - 1, 0)] v from {_EVALUATION_SQL})"""
_JUDGED_SQL = f"""(select label, raw, (raw < (select quantile_cont(raw, {V.FOREST_CONTAMINATION}) from {walk_sql(_FEATURE_LIST)}))::int predicted
    from {_EVALUATION_SQL} join {walk_sql(_EVALUATION_LIST)} using (transaction_id))"""


@catalog.add(
    "forest_report",
    f"""select class, {rounded('coalesce(p, 0)', 6)} "precision", {rounded('coalesce(r, 0)', 6)} recall,
    {rounded('coalesce(2 * p * r / nullif(p + r, 0), 0)', 6)} f1, support
    from (select class, hits / nullif(chosen, 0) p, hits / nullif(support, 0) r, support
      from (select class, count(*) filter (label = side and predicted = side) hits, count(*) filter (predicted = side) chosen,
        count(*) filter (label = side) support from {_JUDGED_SQL}, (values (0, 'normal'), (1, 'anomaly')) c(side, class) group by class))""",
)
def _(spark, folder):
    """Precision, recall and F1 of a given forest at its exact cut."""
    return plain(forest.classification_report(_evaluated(spark, folder, given_forest(spark)), "label", "predicted"))


@catalog.add("forest_mean_scores", f'select label, {rounded("avg(raw)", 9)} mean_score, count(*) "rows" from {_JUDGED_SQL} group by label')
def _(spark, folder):
    return plain(forest.mean_score_per_label(_evaluated(spark, folder, given_forest(spark)), "label"), {"mean_score": 9})
