"""Tabular models on Spark MLlib, evaluation metrics, stable splits.

Training uses MLlib estimators (distributed); metrics are aggregates over
prediction tables.  Splits are hash buckets of a row key, so membership is
stable under repartitioning and re-execution (``randomSplit`` is not).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter.functions.text import col
from arbiter.operators import trees as TR
from arbiter.operators.ranking import hash_bucket


def split_label(key, seed: str = "s", bounds=(60, 80)) -> Column:
    """train / val / test by md5 bucket of the key (0-59 / 60-79 / 80-99)."""
    b = hash_bucket(key, seed)
    return (F.when(b < bounds[0], F.lit("train")).when(b < bounds[1], F.lit("val"))
            .otherwise(F.lit("test")))


def exact_split(df: DataFrame, key: str, shares: dict[str, float], seed: str = "s") -> DataFrame:
    """``df`` with ``split``: sizes exact to the row, membership stable.

    Rows are ordered by (md5 of seed and key, key), which is unique where the
    key is; the first split takes the first share * n of them, rounded, and so
    on.  The row at each cut is a distributed order statistic: rows are counted
    by the first 16 bits of the hash, the counts say which of the 65,536 slices
    holds the cut, and the rows of that slice alone are ranked.  The split is
    then a comparison with the few cuts: nothing is shuffled or sorted.

    A NULL key counts as an empty one; rows of one key stay together (a cut
    that meets a repeated key is off by its copies)."""
    digest, text = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.coalesce(
        F.col(key).cast("string"), F.lit(""))
    x = df.select(digest.alias("h"), text.alias("k"), F.substring(digest, 1, 4).alias("slice"))
    sizes = {r["slice"]: r["count"] for r in x.groupBy("slice").count().collect()}  # 65,536 numbers at most
    total, cuts, share = sum(sizes.values()), [], 0.0
    for name in list(shares)[:-1]:
        share += shares[name]
        cuts.append(int(share * total + 0.5))
    out, at = F.lit(list(shares)[-1]), 0
    bounds: dict[int, tuple[str, str]] = {}
    for slice_name in sorted(sizes):
        inside = [c for c in cuts if at <= c < at + sizes[slice_name]]
        if inside:
            w = Window.orderBy("h", "k")
            ranked = x.where(F.col("slice") == slice_name).select("h", "k", (F.row_number().over(w) - 1 + at).alias("place"))
            bounds |= {r["place"]: (r["h"], r["k"]) for r in ranked.where(F.col("place").isin(inside)).collect()}
        at += sizes[slice_name]
    for name, cut in reversed(list(zip(shares, cuts))):
        if cut < total:
            h, k = bounds[cut]
            out = F.when((digest < h) | ((digest == h) & (text < k)), F.lit(name)).otherwise(out)
        else:
            out = F.lit(name)
    return df.withColumn("split", out)


def exact_mse(pred, label, decimals: int = 2) -> Column:
    """Mean squared error of values stored at ``decimals`` places, summed as
    exact integers (DECIMAL(38,0)) and divided once: independent of
    partitioning and summation order.  Rows without a prediction or a label
    count neither above nor below; NULL where no row has both."""
    scale = 10 ** decimals
    err = F.round((col(pred) - col(label)) * F.lit(float(scale))).cast("decimal(38,0)")
    sq = F.sum(err * err)
    return F.try_divide(sq.cast("double"), F.count(err).cast("double") * F.lit(float(scale * scale)))


def prediction_mse(preds: DataFrame, model_cols: list[str], label: str = "label",
                   decimals: int = 2, common: bool = False) -> DataFrame:
    """MSE per model from a wide prediction table (one column per model), the
    rows it is the mean of (``n``) and those that lack a prediction or a label
    (``n_missing``).  ``common`` keeps to the rows that every model predicted,
    so that models are compared on the same rows."""
    if common:
        preds = preds.dropna(subset=[label, *model_cols])
    long = preds.select(label, *model_cols).unpivot([label], model_cols, "model", "prediction")
    there = F.col("prediction").isNotNull() & F.col(label).isNotNull()
    return long.groupBy("model").agg(exact_mse("prediction", label, decimals).alias("mse"),
                                     F.count_if(there).alias("n"), F.count_if(~there).alias("n_missing"))


def align(key: str, tables: list[DataFrame]) -> DataFrame:
    """One row per key that is in all of ``tables`` (key, one value column of
    doubles): a union and one aggregate instead of a chain of joins.  A key is
    unique within a table."""
    names = [next(c for c in t.columns if c != key) for t in tables]
    long = None
    for n, t in zip(names, tables):
        part = t.select(key, F.lit(n).alias("_name"), F.col(n).cast("double").alias("_value"))
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy(key).agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in names],
                                 F.count(F.lit(1)).alias("_n"))
    return wide.where(F.col("_n") == len(names)).drop("_n")


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, F1 of the positive class from one pass of
    conditional counts."""
    c = df.agg(
        F.count_if((F.col(label) == 1) & (F.col(pred) == 1)).alias("tp"),
        F.count_if((F.col(label) == 0) & (F.col(pred) == 1)).alias("fp"),
        F.count_if((F.col(label) == 1) & (F.col(pred) == 0)).alias("fn"),
        F.count_if((F.col(label) == 0) & (F.col(pred) == 0)).alias("tn"))
    p = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    r = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    out = c.select("tp", "fp", "fn", "tn",
                   F.try_divide(F.col("tp") + F.col("tn"),
                                F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
                   F.coalesce(p, F.lit(0.0)).alias("precision"),
                   F.coalesce(r, F.lit(0.0)).alias("recall"))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return out.withColumn("f1", f1)


def weighted_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy and precision, recall, F1 averaged over the classes with their
    numbers of true rows as weights; one count per (label, prediction) pair,
    so any number of classes and a hot class cost partial aggregates."""
    pairs = df.groupBy(F.col(label).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("t").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    k = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "hit")])
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    k = (k.withColumn("pr", share("hit", "predicted")).withColumn("rc", share("hit", "support"))
         .withColumn("f", F.coalesce(F.try_divide(F.lit(2.0) * F.col("pr") * F.col("rc"), F.col("pr") + F.col("rc")),
                                     F.lit(0.0))))
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return k.agg(F.sum("support").alias("n"), F.count_if(F.col("support") > 0).alias("n_classes"),
                 F.try_divide(F.sum("hit"), F.sum("support")).alias("accuracy"),
                 mean("pr").alias("precision"), mean("rc").alias("recall"), mean("f").alias("f1"))


def feature_stages(features: list[str]) -> list:
    """Impute (training mean; NULL and NaN alike), then assemble: every input
    row has an output row, in training and in inference."""
    filled = [f"_filled_{c}" for c in features]
    return [Imputer(inputCols=features, outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error")]


TREES_PER_FIT = 50             # of a forest's models


def fit_regressor(train: DataFrame, features: list[str], kind: str = "gbt", label: str = "label",
                  seed: int = 123, num_trees: int = 300, max_iter: int = 20) -> PipelineModel:
    # a row without a label can't train; regression_report counts those left out
    labelled = train.where(F.col(label).isNotNull())
    if kind == "linear":
        return Pipeline(stages=[*feature_stages(features), LinearRegression(labelCol=label)]).fit(labelled)
    if kind not in ("gbt", "rf"):
        raise ValueError(kind)
    prepared = Pipeline(stages=feature_stages(features)).fit(labelled)
    # trees pass over their input again and again: rows that no tree can tell
    # apart are counted once
    filled = [f"_filled_{c}" for c in features]
    rows = prepared.stages[0].transform(labelled).select(
        *[F.col(c).cast("double").alias(c) for c in filled], F.col(label).cast("double").alias(label))
    cuts = TR.thresholds(rows, filled)
    points = TR.binned(rows, filled, cuts, label)
    stages = fit_forest(points, cuts, label, seed, num_trees) if kind == "rf" else [
        fit_boosted(points, cuts, label, seed, max_iter)]
    return PipelineModel(stages=[*prepared.stages, *stages])


def fit_boosted(points: DataFrame, cuts: list[list[float]], label: str, seed: int, max_iter: int):
    """Gradient boosting on the cells of ``points``: a tree of squared errors
    splits by means and numbers of rows, so it is the one that the rows give."""
    boosting = GBTRegressor(labelCol=label, maxIter=max_iter, seed=seed)
    x = VectorAssembler(inputCols=TR.bin_names(cuts), outputCol="features").transform(
        TR.cells(points, cuts, label)).select("features", label, "_weight").persist(StorageLevel.DISK_ONLY)
    try:
        return TR.boosted_model(boosting, boosting.copy({boosting.weightCol: "_weight"}).fit(x), cuts)
    finally:
        x.unpersist()


def fit_forest(points: DataFrame, cuts: list[list[float]], label: str, seed: int, num_trees: int) -> list:
    """The stages of a random forest: models of some of the trees each, averaged
    by their number."""
    fits = max(1, -(-num_trees // TREES_PER_FIT))
    sizes = [num_trees // fits + (i < num_trees % fits) for i in range(fits)]
    trees = TR.grow(TR.shards(points, cuts, label), len(cuts), seed, num_trees)
    names = [f"_forest_{i}" for i in range(fits)] if fits > 1 else ["prediction"]
    forests = [TR.forest_model(RandomForestRegressor(labelCol=label, numTrees=n, seed=seed, predictionCol=name),
                               trees[sum(sizes[:i]):sum(sizes[:i + 1])], cuts)
               for i, (n, name) in enumerate(zip(sizes, names))]
    if fits == 1:
        return forests
    mean = " + ".join(f"{n} * {name}" for n, name in zip(sizes, names))
    return [*forests, SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), ({mean}) / {num_trees} AS prediction "
                                               "FROM __THIS__")]


def fit_logreg(train: DataFrame, vector_col: str, label: str = "label",
               max_iter: int = 1000) -> PipelineModel:
    """Multinomial logistic regression (L-BFGS) on an array<float> feature column."""
    prep = train.withColumn("features", array_to_vector(F.col(vector_col)))
    lr = LogisticRegression(labelCol=label, family="multinomial", maxIter=max_iter)
    return Pipeline(stages=[lr]).fit(prep)


def regression_report(model: PipelineModel, train: DataFrame, val: DataFrame,
                      name: str, label: str = "label") -> DataFrame:
    """Validation MSE of the model next to the mean predictor's (from train),
    and the training rows with and without a label."""
    # one answer for the rows that the model can't tell apart
    pv = model.transform(TR.alike(model, val, label))
    m, n_train, n_all = train.agg(F.avg(label), F.count(label), F.count(F.lit(1))).first()

    def mse(answer):
        error = F.col("_labelled") * (F.pow(answer - F.col("_mean"), 2) + F.col("_spread"))
        return F.try_divide(F.sum(error), F.sum("_labelled").cast("double"))

    return pv.agg(
        F.lit(name).alias("model"),
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.lit(n_all - n_train).cast("bigint").alias("n_unlabelled"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_val"),
        mse(F.col("prediction")).alias("val_mse"),
        mse(F.lit(float(m))).alias("baseline_mse"))
