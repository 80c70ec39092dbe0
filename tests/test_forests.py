"""Forests grown in tasks against Spark's own, and nested searches over them."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from tallyloom.operators import forests, models
from tallyloom.plans.models import nested_confusion

COLUMNS = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def points(spark):
    draw, data = random.Random(3), []
    for i in range(240):
        kind = draw.choice([0, 0, 1, 2])
        x = [draw.gauss(kind, 1), draw.gauss(0, 1), float(draw.randrange(4)), 7.0, draw.gauss(-kind, 2), draw.choice([0.0, -0.0, draw.random()])]
        data.append((i, kind, *x))
    rows = spark.createDataFrame(data, "id long, kind int, " + ", ".join(f"{c} double" for c in COLUMNS)).coalesce(1)
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(rows).select("id", "kind", "features").cache()


def accuracy():
    return MulticlassClassificationEvaluator(labelCol="kind", metricName="accuracy")


@pytest.mark.parametrize(
    "settings",
    [
        dict(numTrees=20, maxDepth=8, featureSubsetStrategy="sqrt"), dict(numTrees=3, maxDepth=8, featureSubsetStrategy="all"), dict(numTrees=6, maxDepth=0),
        dict(numTrees=20, maxDepth=5, featureSubsetStrategy="onethird", minInstancesPerNode=4, minInfoGain=0.01), dict(numTrees=1, maxDepth=12, maxBins=8),
        dict(numTrees=37, maxDepth=8, featureSubsetStrategy="log2", maxMemoryInMB=1), dict(numTrees=3, maxDepth=3, featureSubsetStrategy="sqrt", maxMemoryInMB=0),
    ],
)
def test_trees_are_those_of_spark(spark, points, settings):
    estimator = models.forest("kind", **settings)
    expected = DataFrame(estimator._fit_java(points).transform(points._jdf), spark).select("rawPrediction").collect()
    data = points.collect()
    x, y = np.array([r.features.toArray() for r in data]), np.array([r.kind for r in data])
    one, bins = models._forest_settings(estimator, {}, "kind", "features", x.shape[1], "prediction")
    cuts = [forests.thresholds(x[:, f], min(bins, len(x))) for f in range(x.shape[1])]
    codes = forests.binned(x, cuts)
    drawn = models._bootstrap(spark, 42, len(x) * one.trees).reshape(len(x), one.trees)
    keys = np.ascontiguousarray((codes.astype(np.uint16) + (y * bins).astype(np.uint16)[:, None]).T)
    votes = np.zeros((len(x), 3))
    for tree in forests.grow(keys, drawn, bins, 3, np.array([len(c) + 1 for c in cuts]), one):
        votes += tree.votes(np.ascontiguousarray(codes.T))
    assert np.array_equal(votes, [r.rawPrediction.toArray() for r in expected])


def test_split_candidates_of_many_values():
    values = np.arange(1000.0)
    cuts = forests.thresholds(values, 4)
    assert cuts.tolist() == [249.5, 499.5, 749.5]
    assert forests.thresholds(np.full(5, 2.0), 4).tolist() == []
    assert forests.binned(np.array([[249.5], [249.6], [-1.0], [5000.0]]), [cuts]).ravel().tolist() == [0, 1, 0, 3]


def nested(points, widths):
    all_of_them = models.forest("kind", numTrees=4, maxDepth=3)
    chosen = Pipeline(stages=[models.select_best(3, "kind"), models.forest("kind", features="selected", numTrees=4, maxDepth=3)])
    grids = [models.grid_of(e, {"featureSubsetStrategy": widths}) for e in (all_of_them, chosen.getStages()[-1])]
    return models.nested_cv(points, list(zip((all_of_them, chosen), grids)), accuracy(), "kind", ["id"], outer=2, inner=2)


def test_nested_search_in_tasks_is_that_of_sparks_forests(points, monkeypatch):
    widths = ["sqrt", "onethird", "all"]
    ours = nested(points, widths)
    monkeypatch.setattr(models, "TASK_BYTES", 0)  # too large for a task: Spark grows the forests
    theirs = nested(points, widths)
    assert (ours.scores, ours.chosen) == (theirs.scores, theirs.chosen)
    assert ours.predictions.dtypes == theirs.predictions.dtypes
    assert sorted(ours.predictions.collect()) == sorted(theirs.predictions.collect())


def test_nested_search_has_no_jobs_per_forest_and_level(spark, points):
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    begin = jobs()
    found = nested(points, ["sqrt", "all"])
    assert found.predictions.select("id").distinct().count() == 240
    assert jobs() - begin < 120  # 18 forests; Spark's own took some ten jobs each, and the selection is fitted once a part


def test_nested_search_scores_other_measures_and_refuses_bad_rows(spark, points):
    estimator = models.forest("kind", numTrees=2, maxDepth=2)
    by_f1 = MulticlassClassificationEvaluator(labelCol="kind", metricName="f1")
    found = models.nested_cv(points, [(estimator, [{}])], by_f1, "kind", ["id"], outer=2, inner=2)
    one = found.predictions.where("outer = 0")
    assert found.scores[0] == pytest.approx(by_f1.evaluate(one))
    bad = spark.createDataFrame([(i, i % 2, float(i) if i else math.nan) for i in range(40)], "id long, kind int, a double")
    framed = VectorAssembler(inputCols=["a"], outputCol="features", handleInvalid="keep").transform(bad).select("id", "kind", "features")
    with pytest.raises(Exception, match="NaN"):
        models.nested_cv(framed, [(estimator, [{}])], accuracy(), "kind", ["id"], outer=2, inner=2).predictions.collect()


def test_confusion_counts_every_row_once_without_jobs_per_forest(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(i % 3 if f < 12 else 0, 1) for f in range(64)], i % 3) for i in range(150)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    begin = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    table = nested_confusion(spark, str(tmp_path)).collect()
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - begin < 500  # 155 forests: more than 2,000 jobs when Spark grew them
    per_label = {}
    for r in table:
        per_label[r[0]] = per_label.get(r[0], 0) + r["n"]
    assert per_label == {0: 50, 1: 50, 2: 50}
    assert sum(r["n"] for r in table if r[0] == r[1]) > 120


def test_large_nodes_are_counted_block_by_block(monkeypatch):
    draw = np.random.default_rng(2)
    keys, counts = draw.integers(0, 12, (5, 300)).astype(np.uint16), draw.poisson(1, (300, 4)).astype(np.uint8)
    grown = []
    for block in (1 << 16, 7):
        monkeypatch.setattr(forests, "BLOCK", block)
        trees = forests.grow(keys, counts, 4, 3, np.full(5, 4), forests.Settings(4, 6, 3, 42))
        grown.append([(t.feature.tolist(), t.cut.tolist(), t.shares.tolist()) for t in trees])
    assert grown[0] == grown[1]
