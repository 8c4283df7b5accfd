"""Tree models: bounded fits, and a training frame that is derived once."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from arbiter.operators import ml as ML
from arbiter.operators import trees as TR


def training(spark, n=400):
    return spark.range(n).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                 F.when(F.col("id") % 50 > 0, F.col("id") % 7 + 2.0 * (F.col("id") % 11)).alias("label"))


def test_a_large_forest_is_trained_in_bounded_fits(spark):
    df = training(spark)
    trees = 2 * ML.TREES_PER_FIT + 1
    model = ML.fit_regressor(df, ["a", "b"], "rf", num_trees=trees)
    forests = [s for s in model.stages if isinstance(s, RandomForestRegressionModel)]
    sizes = [f.getNumTrees for f in forests]
    assert sum(sizes) == trees and 1 < min(sizes) and max(sizes) <= ML.TREES_PER_FIT
    assert len({t.toDebugString for f in forests for t in f.trees}) > trees // 2  # other samples in every fit
    out = model.transform(df)
    assert out.columns == [*df.columns, "_filled_a", "_filled_b", "features", "prediction"]
    for r in out.limit(5).collect():
        want = sum(t.predict(r.features) for f in forests for t in f.trees) / trees
        assert abs(r.prediction - want) < 1e-9
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_a_training_report_derives_its_rows_once(spark, monkeypatch):
    from arbiter.plans import ml_plans as P
    from conftest import SF_SMALL
    plans, fit = [], ML.fit_regressor

    def watched(train, *args, **kw):
        plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        return fit(train, *args, **kw)

    monkeypatch.setattr(ML, "fit_regressor", watched)
    [row] = P._report(spark, SF_SMALL, "gbt", max_iter=2).collect()
    assert row.n_train > row.n_val > 0 and row.n_unlabelled == 0
    assert len(plans) == 1 and "md5" not in plans[0]


def noisy(spark, n=6000):
    """Few values of the features, another label in every row."""
    return spark.range(n).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                 ((F.col("id") % 7) * (F.col("id") % 11) + F.sin(F.col("id"))).alias("label"))


def test_boosting_trains_on_cells_and_gives_the_trees_of_the_rows(spark, monkeypatch):
    df, seen = noisy(spark), []
    fit = GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, x, *a: (seen.append(x.count()), fit(self, x, *a))[1])
    model = ML.fit_regressor(df, ["a", "b"], "gbt", max_iter=4)
    monkeypatch.undo()
    assert seen == [77]  # 7 x 11, not 6000
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    plain = GBTRegressor(maxIter=4, seed=123).fit(x)
    [mine] = [m for m in model.stages if isinstance(m, GBTRegressionModel)]
    assert mine.getMaxIter() == 4 and mine.numFeatures == 2 and mine.treeWeights == plain.treeWeights
    for r in x.limit(77).collect():
        assert abs(mine.predict(r.features) - plain.predict(r.features)) < 1e-6


def test_a_grown_tree_is_the_one_of_its_sample(spark):
    """The only tree of a forest against MLlib's on the same drawn weights."""
    points = TR.binned(noisy(spark).select("a", "b", "label"), ["a", "b"], [[x + 0.5 for x in range(6)],
                                                                        [x + 0.5 for x in range(10)]], "label")
    records = TR.shards(points, [[0.0], [0.0]], "label")
    [tree] = TR.grow(records, 2, 7, 1)
    drawn = []
    for r in records.collect():
        n, label = np.frombuffer(r.n, np.int64), np.frombuffer(r.labels)
        bins = np.frombuffer(r.bins, np.uint8).reshape(2, -1)
        w = TR.draws(np.random.default_rng([7, 0, r.shard]), n)
        drawn += [(float(a), float(b), float(y), float(k)) for a, b, y, k in zip(*bins, label, w) if k]
    assert tree[1][0][0] == sum(d[3] for d in drawn)
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(drawn, "a double, b double, label double, w double"))
    plain = RandomForestRegressor(numTrees=1, bootstrap=False, weightCol="w").fit(x)
    mine = TR.forest_model(RandomForestRegressor(numTrees=1), [tree], [[float(i) for i in range(6)], [float(i) for i in range(10)]])
    assert mine.trees[0].numNodes == plain.trees[0].numNodes
    assert np.allclose(mine.featureImportances.toArray(), plain.featureImportances.toArray())
    for r in x.collect():
        assert abs(mine.predict(r.features) - plain.predict(r.features)) < 1e-6


def test_rows_are_drawn_one_by_one():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40):
        w = TR.draws(rng, np.full(200_000, n))
        assert abs(w.mean() - n) < 0.05 * n and abs(w.var() - n) < 0.05 * n
    one = np.bincount(TR.draws(rng, np.ones(400_000, np.int64)).astype(int), minlength=4)[:4] / 400_000
    assert np.allclose(one, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.005)


def test_thresholds_of_few_and_of_many_values(spark):
    assert TR.cut_points([3, 1, 1, 2]) == [1.5, 2.5] and TR.cut_points([5.0, 5.0]) == []
    cuts = TR.cut_points(range(6400))
    assert len(cuts) == TR.BINS - 1 and all(abs(c - 200 * (i + 1)) < 3 for i, c in enumerate(cuts))
    [few, many] = TR.thresholds(spark.range(50_000).select((F.col("id") % 3).cast("double").alias("a"),
                                                           F.col("id").cast("double").alias("b")), ["a", "b"])
    assert few == [0.5, 1.5] and len(many) == TR.BINS - 1


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_a_report_answers_like_rows_once(spark, kind):
    df = noisy(spark, 3000).withColumn("b", F.when(F.col("b") > 0, F.col("b"))).union(
        spark.createDataFrame([(1.0, 2.0, None), (float("nan"), None, 3.0)], "a double, b double, label double"))
    model = ML.fit_regressor(df, ["a", "b"], kind, num_trees=5, max_iter=3)
    assert TR.alike(model, df, "label").count() <= 80
    got = ML.regression_report(model, df, df, kind).first()
    mean = df.agg(F.avg("label")).first()[0]
    want = model.transform(df).agg(F.count(F.lit(1)).alias("n"), F.avg(F.pow(F.col("prediction") - F.col("label"), 2)).alias("m"),
                                   F.avg(F.pow(mean - F.col("label"), 2)).alias("b")).first()
    assert got.n_val == want.n == 3002 and got.n_unlabelled == 1
    assert abs(got.val_mse - want.m) < 1e-6 * want.m and abs(got.baseline_mse - want.b) < 1e-6 * want.b
    none = ML.regression_report(model, df, df.where("false"), kind).first()
    assert none.n_val == 0 and none.val_mse is None


def test_a_constant_feature_and_an_infinite_label(spark):
    df = noisy(spark, 500).withColumn("c", F.lit(2.0))
    for kind in ("gbt", "rf"):
        model = ML.fit_regressor(df, ["c", "a"], kind, num_trees=4, max_iter=2)
        assert model.transform(df).where("prediction is null").count() == 0
        with pytest.raises(Exception, match="NaN or [Ii]nfin"):
            ML.fit_regressor(df.withColumn("label", F.lit(float("inf"))), ["a"], kind, num_trees=2, max_iter=1)
