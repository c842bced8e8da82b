import numpy as np
import pytest
from pyspark.sql import functions as F

from martweave import fixed_values as V
from martweave.operators import forest
from martweave.session import pin


@pytest.fixture(scope="module")
def normal(spark):
    r = np.random.default_rng(1)
    rows = []
    for i in range(3000):
        amount, baseline = float(r.lognormal(6, 0.5)), 50000.0
        weekday = float(r.integers(0, 5))
        rows.append((i, amount, amount / baseline, float(np.log1p(amount)), float(r.integers(8, 19)), weekday, 0.0, float(r.random() < 0.1), float(r.integers(0, 10))))
    return spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{n} double" for n in V.FEATURE_NAMES))


@pytest.fixture(scope="module")
def nodes(spark, normal):
    return pin(forest.fit(normal, "id"), "test-forest")


def case(spark, amount, hour, weekday):
    row = (0, amount, amount / 50000, float(np.log1p(amount)), hour, weekday, float(weekday >= 5), 0.0, 1.0)
    return spark.createDataFrame([row], "id bigint, " + ", ".join(f"{n} double" for n in V.FEATURE_NAMES))


def score(df, nodes):
    return [r.ml_raw_score for r in forest.with_raw_score(df, nodes).collect()]


def test_anomaly_scores_lower(spark, nodes):
    usual, odd = score(case(spark, 500.0, 10.0, 1.0), nodes)[0], score(case(spark, 100000.0, 3.0, 6.0), nodes)[0]
    assert -1 <= odd < usual < 0


def test_every_tree_gets_its_sample(nodes):
    shape = nodes.groupBy("tree").agg(F.max("sample").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert len(shape) == V.FOREST_TREES and {r.s for r in shape} == {V.FOREST_SAMPLE}
    assert max(r.n for r in shape) <= 2 * V.FOREST_SAMPLE - 1


def test_trees_draw_at_random_and_no_more_than_their_sample(normal):
    drawn = forest.tree_samples(normal, "id", V.FEATURE_NAMES, 20, 64, 7, normal.count())
    sizes = drawn.groupBy("tree").count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {64}
    assert drawn.select("_key").distinct().count() > 400


def test_trees_are_full_where_few_rows_are_usable(spark, normal):
    few = normal.withColumn(V.FEATURE_NAMES[0], F.when(F.col("id") % 8 == 0, F.col(V.FEATURE_NAMES[0])))
    sizes = forest.fit(few, "id").groupBy("tree").agg(F.max("sample").alias("s")).collect()
    usable = forest.usable_rows(few, V.FEATURE_NAMES).count()
    assert {r.s for r in sizes} == {min(V.FOREST_SAMPLE, usable)}


def test_same_fit_twice(normal, nodes):
    again = forest.fit(normal.repartition(7), "id")
    assert again.exceptAll(nodes).count() == 0


def test_scores_equal_a_plain_walk(normal, nodes):
    table = {(r.tree, r.node): r for r in nodes.collect()}
    rows = normal.limit(20).collect()
    scale = float(forest.average_path([V.FOREST_SAMPLE])[0])
    expected = []
    for row in rows:
        x = [row[n] for n in V.FEATURE_NAMES]
        paths = []
        for tree in range(V.FOREST_TREES):
            at = table[(tree, 0)]
            while at.feature >= 0:
                at = table[(tree, at.below if x[at.feature] <= at.threshold else at.above)]
            paths.append(at.path)
        expected.append(-(2 ** (-np.mean(paths) / scale)))
    assert score(normal.limit(20), nodes) == pytest.approx(expected)


def test_missing_feature_gives_no_score(spark, nodes):
    df = case(spark, 500.0, 10.0, 1.0).withColumn("hour_of_day", F.lit(None).cast("double"))
    assert score(df, nodes) == [None]


def test_contamination_and_report(normal, nodes):
    scored = pin(forest.with_raw_score(normal, nodes), "scored")
    cut = forest.threshold(scored)
    low = forest.with_prediction(scored, cut).filter("prediction = -1").count()
    assert 20 <= low <= 40
    labelled = scored.sparkSession.createDataFrame([(0, 0)] * 8 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)], "y int, p int")
    report = {r["class"]: r for r in forest.classification_report(labelled, "y", "p").collect()}
    assert report["anomaly"].precision == 0.6 and report["anomaly"].recall == 0.75 and report["normal"].support == 10


def test_save_and_load(spark, nodes, folder):
    forest.save(nodes, folder + "/model")
    assert forest.load(spark, folder + "/model").exceptAll(nodes).count() == 0


def test_oversized_model_is_refused(nodes, normal):
    with pytest.raises(ValueError):
        forest.with_raw_score(normal, nodes, trees=2, sample_size=8)
