"""Tabular model training/comparison, metrics, splits, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter.functions.rounding import exact_round_sql as XR
from arbiter.operators import ml as ML
from arbiter.operators import vectors as VX
from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import register_view, with_views
from arbiter.sources import fixtures as FX
from arbiter.sources.materialize import checkpointed
from arbiter.sources.tables import read_table

register_view("tabular", (), """
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
             || '-' || CAST(l_linenumber AS VARCHAR) AS row_id,
           CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_discount AS DOUBLE) AS discount,
           CAST(l_extendedprice AS DOUBLE) AS label,
           l_quantity * 1500.0 AS p1, l_quantity * 1500.0 * (1.0 - l_discount) AS p2
    FROM lineitem""")
# the second model gives no answer for some rows
PARTIAL_P2 = "CASE WHEN NOT (quantity > 45 AND discount < 0.03) THEN p2 END"
register_view("splits", ("tabular",), """
    SELECT row_id, label, quantity, discount, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split
    FROM (SELECT row_id, label, quantity, discount, ('0x' || substr(md5('s' || row_id), 1, 8))::BIGINT % 100 AS b FROM tabular) t""")
MSE_SQL = ("CAST(sum(CAST(round((p - label) * 100) AS HUGEINT) * CAST(round((p - label) * 100) AS HUGEINT)) "
           "AS DOUBLE) / (CAST(count(p) AS DOUBLE) * 10000.0)")
register_view("mse", ("tabular",), f"""
    SELECT model, {MSE_SQL} AS mse, CAST(count(p) AS BIGINT) AS n, CAST(count(*) - count(p) AS BIGINT) AS n_missing FROM (
      SELECT 'p1' AS model, p1 AS p, label FROM tabular UNION ALL SELECT 'p2', {PARTIAL_P2}, label FROM tabular) u
    GROUP BY model""")
register_view("mse_common", ("tabular",), f"""
    SELECT model, {MSE_SQL} AS mse FROM (
      SELECT 'p1' AS model, p1 AS p, label FROM tabular WHERE {PARTIAL_P2} IS NOT NULL
      UNION ALL SELECT 'p2', {PARTIAL_P2}, label FROM tabular) u
    GROUP BY model""")


def tab(spark, sf_dir):
    return FX.tabular(spark, sf_dir)


def predictions(spark, sf_dir):
    return tab(spark, sf_dir).withColumn("p2", F.expr(PARTIAL_P2))


def with_split(spark, sf_dir):
    return tab(spark, sf_dir).withColumn("split", ML.split_label("row_id"))


@query("split_partition", with_views("SELECT row_id, split FROM splits", "splits"))
def q_split_partition(spark, sf_dir):
    return with_split(spark, sf_dir).select("row_id", "split")


@query("split_exact", with_views("""
    SELECT row_id, label, CASE WHEN place < floor(0.6 * n + 0.5) THEN 'train'
                               WHEN place < floor(0.8 * n + 0.5) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT row_id, label, row_number() OVER (ORDER BY md5('s' || row_uid)) - 1 AS place, count(*) OVER () AS n
          FROM (SELECT row_id, label, row_id || '#' || CAST(row_number() OVER (PARTITION BY row_id
                         ORDER BY l_quantity, l_discount, l_tax, month(l_shipdate), year(l_shipdate), label) AS VARCHAR)
                       AS row_uid
                FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-'
                             || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS row_id,
                             CAST(l_extendedprice AS DOUBLE) AS label FROM lineitem) l) k) r""", "tabular"))
def q_split_exact(spark, sf_dir):
    keyed = FX.tabular_keyed(spark, sf_dir).select("row_id", "row_uid", "label")
    split = ML.exact_split(keyed, "row_uid", {"train": 0.6, "val": 0.2, "test": 0.2})
    return split.select("row_id", "label", "split")


@query("positional_align", """
    SELECT row_uid, round_even(p1, 6) AS p1, round_even(p2, 6) AS p2, round_even(label, 6) AS label FROM (
      SELECT *, row_id || '#' || CAST(row_number() OVER (PARTITION BY row_id ORDER BY quantity, discount, tax,
                                      ship_month, ship_year, label) AS VARCHAR) AS row_uid
      FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                     || '-' || CAST(l_linenumber AS VARCHAR) AS row_id,
                   CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_discount AS DOUBLE) AS discount,
                   CAST(l_tax AS DOUBLE) AS tax, CAST(month(l_shipdate) AS DOUBLE) AS ship_month,
                   CAST(year(l_shipdate) AS DOUBLE) AS ship_year, CAST(l_extendedprice AS DOUBLE) AS label,
                   l_quantity * 1500.0 AS p1, l_quantity * 1500.0 * (1.0 - l_discount) AS p2
            FROM lineitem) t) k""")
def q_positional_align(spark, sf_dir):
    from arbiter.operators.scoring import materialize
    # labels and the predictions of two models are separate results; they are
    # written once and aligned on an explicit unique row key (never on position)
    t = materialize(FX.tabular_keyed(spark, sf_dir).select("row_uid", "label", "p1", "p2"), spark, "predictions")
    return finalize(ML.align("row_uid", [t.select("row_uid", c) for c in ("label", "p1", "p2")]))


@query("prediction_mse", with_views(f"SELECT model, {XR('mse', 6)} AS mse, n, n_missing FROM mse", "mse"))
def q_prediction_mse(spark, sf_dir):
    return finalize(ML.prediction_mse(predictions(spark, sf_dir), ["p1", "p2"]), exact=True)


@query("model_compare", with_views(f"""
    SELECT arg_min(model, mse) AS champion, {XR('min(mse)', 6)} AS champion_mse,
           {XR('max(mse)', 6)} AS challenger_mse, 'set_alias' AS kind, 'Champion' AS alias FROM mse_common""",
    "mse_common"))
def q_model_compare(spark, sf_dir):
    # both models on the rows that both predicted: no answer is no advantage
    m = ML.prediction_mse(predictions(spark, sf_dir), ["p1", "p2"], common=True)
    out = m.agg(F.min_by("model", "mse").alias("champion"), F.min("mse").alias("champion_mse"),
                F.max("mse").alias("challenger_mse"))
    return finalize(out.select("*", F.lit("set_alias").alias("kind"), F.lit("Champion").alias("alias")),
                    exact=True)


@query("classification_metrics", """
    SELECT tp, fp, fn, tn, round_even((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
           round_even(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
           round_even(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
           round_even(coalesce(2.0 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                      / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0.0), 6) AS f1
    FROM (SELECT CAST(count_if(l.quality = 1 AND d.n_chars > 1000) AS BIGINT) AS tp,
                 CAST(count_if(l.quality = 0 AND d.n_chars > 1000) AS BIGINT) AS fp,
                 CAST(count_if(l.quality = 1 AND d.n_chars <= 1000) AS BIGINT) AS fn,
                 CAST(count_if(l.quality = 0 AND d.n_chars <= 1000) AS BIGINT) AS tn
          FROM labels l JOIN documents d ON d.doc_id = l.doc_id) c""")
def q_classification_metrics(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    j = lab.join(d, "doc_id").select(F.col("quality").alias("label"),
                                     (F.col("n_chars") > 1000).cast("int").alias("prediction"))
    m = ML.binary_metrics(j)
    return finalize(m.select(*[F.col(c).cast("bigint") for c in ("tp", "fp", "fn", "tn")],
                             "accuracy", "precision", "recall", "f1"))


register_view("pool", (), """
    SELECT label, pos, avg(CAST(v AS DOUBLE)) AS mean
    FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings) x
    GROUP BY label, pos""")


@query("mean_pool", with_views("SELECT label, pos, round_even(mean, 6) AS mean FROM pool", "pool"))
def q_mean_pool(spark, sf_dir):
    v = FX.vectors(spark, sf_dir)
    return finalize(VX.mean_pool_long(v, "label", "embedding").select(
        "label", F.col("pos").cast("bigint").alias("pos"), "mean"))


_DOT = "list_reduce(list_transform(list_zip({0}, {1}), lambda p: p[1] * p[2]), lambda x, y: x + y)"
register_view("topk", ("pool",), f"""
    SELECT qid, CAST(rank AS INTEGER) AS rank, id, round_even(score, 6) AS score FROM (
      SELECT q.qid, t.id, {_DOT.format('q.qv', 't.tv')} AS score,
             row_number() OVER (PARTITION BY q.qid ORDER BY {_DOT.format('q.qv', 't.tv')} DESC, t.id) AS rank
      FROM (SELECT qid, list_transform(v, lambda x: x / n) AS qv FROM (
              SELECT qid, v, sqrt({_DOT.format('v', 'v')}) AS n FROM (
                SELECT label AS qid, list(mean ORDER BY pos) AS v FROM pool GROUP BY label) c) c2) q,
           (SELECT id, list_transform(v, lambda x: x / n) AS tv FROM (
              SELECT vec_id AS id, v, sqrt({_DOT.format('v', 'v')}) AS n FROM (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) e) e2) t
    ) s WHERE rank <= 5""")


@query("vector_topk", with_views("SELECT qid, rank, id, score FROM topk", "topk"))
def q_vector_topk(spark, sf_dir):
    # queries: the label centroids (pooled from the table itself); k = 5
    v = FX.vectors(spark, sf_dir)
    cent = VX.mean_pool(v, "label", "embedding")
    top = VX.cosine_topk(v, "vec_id", "embedding", cent, "label", "pooled", 5)
    return finalize(top.select(F.col("qid").cast("int").alias("qid"),
                               F.col("rank").cast("int").alias("rank"), "id", "score"))


# Training data with signal: the price follows quantity and discount, and a
# price that is not known is no label.
SIGNAL = "CASE WHEN label IS NOT NULL THEN 900 * quantity * (1 - 4 * discount) + 300 * (pmod(quantity, 7)) END"


def _report(spark, sf_dir, kind, **kw):
    """Row counts of the split, and how much of the variance the model
    explains on rows it has not seen."""
    s = with_split(spark, sf_dir).withColumn("label", F.expr(SIGNAL)).select(*FX.TABULAR_FEATURES, "label", "split")
    s = checkpointed(s, "training", ["split"])  # key and hash of each row once, not once a pass
    train = s.where(F.col("split") == "train")
    val = s.where(F.col("split") == "val")
    model = ML.fit_regressor(train, FX.TABULAR_FEATURES, kind, **kw)
    r = ML.regression_report(model, train, val, kind)
    return r.select("model", "n_train", "n_unlabelled", "n_val",
                    (F.col("val_mse") < 0.1 * F.col("baseline_mse")).alias("explains_most"))


def _report_sql(kind: str) -> str:
    return with_views(f"""
    SELECT '{kind}' AS model, CAST(count(label) FILTER (split = 'train') AS BIGINT) AS n_train,
           CAST(count(*) FILTER (split = 'train' AND label IS NULL) AS BIGINT) AS n_unlabelled,
           CAST(count(*) FILTER (split = 'val') AS BIGINT) AS n_val, true AS explains_most
    FROM splits""", "splits")


@query("train_gbt", _report_sql("gbt"))
def q_train_gbt(spark, sf_dir):
    return _report(spark, sf_dir, "gbt")


@query("train_rf", _report_sql("rf"))
def q_train_rf(spark, sf_dir):
    return _report(spark, sf_dir, "rf", num_trees=300)


_VEC_BUCKET = "(CAST('0x' || substr(md5('s' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 100)"


# Classes with signal: the signs of the first two components.
_CLASS = "CASE WHEN embedding[0] > 0 THEN 2 WHEN embedding[1] > 0 THEN 1 ELSE 0 END"


@query("train_logreg", f"""
    SELECT CAST(count(*) FILTER ({_VEC_BUCKET} < 80) AS BIGINT) AS n_train,
           CAST(count(*) FILTER ({_VEC_BUCKET} >= 80) AS BIGINT) AS n_test,
           true AS known_labels_only, true AS beats_the_largest_class
    FROM embeddings""")
def q_train_logreg(spark, sf_dir):
    v = FX.vectors(spark, sf_dir).withColumn("label", F.expr(_CLASS)).withColumn(
        "split", F.when(ML.hash_bucket("vec_id") < 80, F.lit("train")).otherwise(F.lit("test")))
    train = v.where(F.col("split") == "train")
    test = v.where(F.col("split") == "test")
    model = ML.fit_logreg(train, "embedding", max_iter=1000)
    from pyspark.ml.functions import array_to_vector
    pred = model.transform(test.withColumn("features", array_to_vector("embedding")))
    n_train, top = train.agg(F.count(F.lit(1)), F.max("label")).first()
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    largest = F.greatest(*[F.avg((F.col("label") == c).cast("double")) for c in range(3)])
    return pred.agg(F.lit(n_train).cast("bigint").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
                    F.bool_and(F.col("prediction").between(0, top)).alias("known_labels_only"),
                    (hit > largest + 0.15).alias("beats_the_largest_class"))


# Three models under one registry, each of one feature; every row is scored by
# the model of its quantity.  The last model has no champion for some rows.
_ROUTE = "CASE WHEN quantity < 15 THEN 'small' WHEN quantity < 30 THEN 'middle' WHEN quantity < 45 THEN 'large' ELSE 'none' END"


@query("alias_batch_inference", with_views(f"""
    , t AS (SELECT *, {_ROUTE} AS model FROM splits),
    c AS (SELECT 'small' AS model, '1' AS version, regr_intercept(label, quantity) AS a, regr_slope(label, quantity) AS b,
                 0.0 AS d FROM t WHERE split = 'train'
          UNION ALL SELECT 'middle', '2', regr_intercept(label, quantity), regr_slope(label, quantity), 0.0
          FROM t WHERE split = 'train' AND model = 'middle'
          UNION ALL SELECT 'large', '1', regr_intercept(label, discount), 0.0, regr_slope(label, discount)
          FROM t WHERE split = 'train')
    SELECT t.row_id, t.model, c.version, round_even(c.a + c.b * t.quantity + c.d * t.discount, 3) AS prediction
    FROM t LEFT JOIN c ON c.model = t.model WHERE t.split = 'test'""", "splits"))
def q_alias_batch_inference(spark, sf_dir):
    from arbiter.operators.model_store import ModelStore
    s = with_split(spark, sf_dir).withColumn("model", F.expr(_ROUTE))
    train = s.where(F.col("split") == "train")
    store = ModelStore.fresh(spark, "small")
    one, two, three = (ML.fit_regressor(train, ["quantity"], "linear"), ML.fit_regressor(
        train.where("model = 'middle'"), ["quantity"], "linear"), ML.fit_regressor(train, ["discount"], "linear"))
    # small: rolled back, so the alias names the newest write; middle: its
    # second version; large: set by a store that was opened again
    store.set_alias("Champion", store.register(one))
    store.set_alias("Champion", store.register(three))
    ModelStore(spark, store.root, "small").set_alias("Champion", "1")
    middle = store.sibling("middle")
    middle.register(one)
    middle.set_alias("Champion", middle.register(two))
    large = store.sibling("large")
    large.set_alias("Champion", large.register(three))
    test = s.where(F.col("split") == "test").select("row_id", "model", "quantity", "discount")
    scored = store.predict_by_alias(test, "model", "Champion")
    return finalize(scored.select("row_id", "model", "version", "prediction"), 3)


@query("classification_metrics_weighted", """
    WITH d AS (SELECT substr(source, 4)::INT % 4 AS t, length(text) % 5 AS p FROM documents),
    c AS (SELECT DISTINCT t AS c FROM d UNION SELECT DISTINCT p FROM d),
    k AS (SELECT c, (SELECT count(*) FROM d WHERE t = c) AS s, (SELECT count(*) FROM d WHERE p = c) AS q,
                 (SELECT count(*) FROM d WHERE t = c AND p = c) AS h FROM c),
    m AS (SELECT *, CASE WHEN q > 0 THEN h / q ELSE 0 END AS pr, CASE WHEN s > 0 THEN h / s ELSE 0 END AS rc FROM k)
    SELECT CAST(sum(s) AS BIGINT) AS n, CAST(count(*) FILTER (s > 0) AS BIGINT) AS n_classes,
           round_even(sum(h) / sum(s), 6) AS accuracy, round_even(sum(pr * s) / sum(s), 6) AS precision,
           round_even(sum(rc * s) / sum(s), 6) AS recall,
           round_even(sum(CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) ELSE 0 END * s) / sum(s), 6) AS f1
    FROM m""")
def q_classification_metrics_weighted(spark, sf_dir):
    # four true classes, five predicted ones: a class that is never true has no weight
    d = FX.read_table(spark, sf_dir, "documents", ["text", "source"]).select(
        (F.substring("source", 4, 16).cast("int") % 4).alias("label"), (F.length("text") % 5).alias("prediction"))
    return finalize(ML.weighted_metrics(d))
