"""Scoring queries (B2-B12) with DuckDB oracles for the rules on the score table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.q_train import MEMBERS, STACK_POINTS
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.operators import clean as P
from adlytics.operators import jobs as J
from adlytics.operators import metrics as E
from adlytics.operators import train as L
from adlytics.plans import prep as PP
from adlytics.plans import scoring as B
from adlytics.plans.registry import Registry
from adlytics.session import cut_lineage, scratch_path

CONT = T.DOC_CONT
BIN = T.doc_binary_cols()
S = T.scores_sql()
DW = T.doc_wide_sql()


def _fit_models(spark, sf_dir, families=MEMBERS, impute="median"):
    """(preparation, models, new rows): fitted on the labelled documents; new rows are the others."""
    dw = cut_lineage(T.doc_wide(spark, sf_dir))
    train, new = dw.filter("y IS NOT NULL"), dw.filter("y IS NULL").drop("y")
    prepared, prep = PP.fit_prep(train, "doc_id", "y", CONT, BIN, protected="X4", impute=impute)
    feats = [c for c in prep.columns if c not in ("doc_id", "y")]
    tr = cut_lineage(prepared.withColumn("label", F.col("y").cast("double")))
    fits = {f: (lambda f=f: L.pipeline(feats, f, params=STACK_POINTS.get(f)).fit(tr)) for f in families}
    return prep, J.values(J.run_jobs(spark, fits)), new


def _registry(spark, sf_dir, families=MEMBERS, impute="knn"):
    """The models of one variant, fitted on rows prepared by its imputation and stored; a threshold for
    one of them."""
    prep, models, new = _fit_models(spark, sf_dir, families, impute)
    feats = [c for c in prep.columns if c not in ("doc_id", "y")]
    reg = Registry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}"))
    for i, (f, m) in enumerate(models.items()):
        reg.put_pipeline(f, impute, ("full", "reduced", "")[i % 3], m, feats)
    reg.put_threshold("xgboost", impute, "reduced", 0.4)
    return reg, prep, new


@register("b02_b03_end_to_end_predict")
def b02(spark, sf_dir):
    """Five members on the unlabelled documents, training columns strictly required."""
    prep, models, new = _fit_models(spark, sf_dir)
    return B.predict(new, prep, models, "doc_id", 0.5, strict=True)


@register("b03_generated_ids", "SELECT CAST(unnest(range(1, (SELECT count(*) + 1 FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.toxic IS NULL))) AS BIGINT) AS \"ID\"")
def b03(spark, sf_dir):
    """A scoring table without a key column gets ids 1..n."""
    prep, models, new = _fit_models(spark, sf_dir, ["lr"])
    return B.predict(new.drop("doc_id"), PP.without_id(prep, "ID"), models, "ID", 0.5).select("ID")


@register("b04_b07_dispatch_by_model")
def b04(spark, sf_dir):
    """Dispatched runs: a model with a saved threshold, one without, and all members' mean; every
    rung of the version ladder is met."""
    reg, prep, new = _registry(spark, sf_dir)
    out = None
    for model in ("xgboost", "svm", "stacking", "stacking_refit"):
        run = B.run_prediction(reg, new, prep, "doc_id", model, "knn", strict=True)
        p = run.predictions.withColumn("asked", F.lit(model)).withColumn("model", F.lit(run.model)) \
            .withColumn("versions", F.lit(",".join(f"{k}:{v}" for k, v in sorted(run.versions.items()))))
        out = p if out is None else out.unionByName(p)
    return out


@register("b04_b08_single_model_saved_threshold")
def b04_single(spark, sf_dir):
    """One stored model at its saved threshold."""
    reg, prep, new = _registry(spark, sf_dir, ["randforest", "xgboost"])
    return B.run_prediction(reg, new, prep, "doc_id", "xgboost", "knn").predictions


@register("b08_challenge_run")
def b08(spark, sf_dir):
    reg, prep, new = _registry(spark, sf_dir)
    run, paths = B.run_challenge(reg, new, prep, "doc_id", scratch_path(spark, f"challenge-{uuid.uuid4().hex[:8]}"))
    return spark.read.parquet(paths["detailed"])


@register("b05_submission_file", """SELECT CASE WHEN n_chars > 3000 THEN 'ad.' ELSE 'noad.' END AS label FROM documents""")
def b05(spark, sf_dir):
    """A submission of a rule's labels for all documents, written and read back."""
    docs = T.read(spark, sf_dir, "documents")
    pred = P.decode_target(docs.select("doc_id", (F.col("n_chars") > 3000).cast("int").alias("prediction")), "prediction", "label")
    path = B.write_submission(pred, scratch_path(spark, f"submission-{uuid.uuid4().hex[:8]}"), expected_rows=docs.count())
    return spark.read.csv(path).withColumnRenamed("_c0", "label")


_MP = f"""mp AS (SELECT id, split, imputation, max(y) AS y, round(avg(p), 6) + 0.0 AS p FROM s
  WHERE model IN ({', '.join(f"'{m}'" for m in MEMBERS)}) GROUP BY id, split, imputation)"""


@register("b06_prediction_stats", f"""WITH s AS {S}, {_MP}
SELECT imputation, count(*) AS n, count_if(p >= 0.5) AS n_positive, {r6('avg(CAST(p >= 0.5 AS DOUBLE))')} AS positive_rate,
  {r6('avg(p)')} AS mean_probability, 0.5 AS threshold FROM mp WHERE split = 'test' GROUP BY imputation""")
def b06(spark, sf_dir):
    mp = L.mean_probability(T.scores(spark, sf_dir), MEMBERS, ["split", "imputation"]).filter(F.col("split") == "test")
    pred = mp.withColumn("prediction", (F.col("p") >= 0.5).cast("int")).withColumnRenamed("p", "probability")
    out = None
    for imp in ("knn", "mice"):
        st = B.prediction_stats(pred.filter(F.col("imputation") == imp), threshold=0.5).withColumn("imputation", F.lit(imp))
        out = st if out is None else out.unionByName(st)
    return out


@register("b09_side_by_side_variants", f"""WITH s AS {S}, {_MP},
g AS (SELECT CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range(1, 100) r(i)),
cc AS (SELECT imputation, threshold, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn FROM mp, g WHERE split = 'val' GROUP BY 1, 2),
cur AS (SELECT imputation, threshold, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 6) AS f1 FROM cc),
best AS (SELECT imputation, threshold FROM (SELECT *, row_number() OVER (PARTITION BY imputation ORDER BY f1 DESC, threshold) AS rn FROM cur) WHERE rn = 1),
t AS (SELECT id, imputation, p, CAST(p >= threshold AS INTEGER) AS pred FROM mp JOIN best USING (imputation) WHERE split = 'test')
SELECT id, max(CASE WHEN imputation = 'knn' THEN pred END) AS knn_pred, max(CASE WHEN imputation = 'knn' THEN p END) AS knn_p,
  max(CASE WHEN imputation = 'mice' THEN pred END) AS mice_pred, max(CASE WHEN imputation = 'mice' THEN p END) AS mice_p
FROM t GROUP BY id""")
def b09(spark, sf_dir):
    mp = L.mean_probability(T.scores(spark, sf_dir), MEMBERS, ["split", "imputation"])
    th = E.grid_threshold_search(mp.filter(F.col("split") == "val"), ["imputation"]).select("imputation", "threshold")
    return B.side_by_side(mp.filter(F.col("split") == "test"), th, "imputation")


@register("b10_best_stack_prediction", f"""WITH s AS {S}, {_MP},
g AS (SELECT CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range(1, 100) r(i)),
cc AS (SELECT imputation, threshold, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn FROM mp, g WHERE split = 'val' GROUP BY 1, 2),
cur AS (SELECT imputation, threshold, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 6) AS f1 FROM cc),
best AS (SELECT imputation, threshold, f1 FROM (SELECT *, row_number() OVER (PARTITION BY imputation ORDER BY f1 DESC, threshold) AS rn FROM cur) WHERE rn = 1),
one AS (SELECT * FROM best ORDER BY f1 DESC, imputation = 'mice', imputation LIMIT 1)
SELECT mp.id, mp.y, mp.p, CAST(mp.p >= threshold AS INTEGER) AS prediction, imputation AS variant, threshold
FROM mp JOIN one USING (imputation) WHERE split = 'test'""")
def b10(spark, sf_dir):
    s = T.scores(spark, sf_dir)
    mp = L.mean_probability(s, MEMBERS, ["split", "imputation"])
    val = E.grid_threshold_search(mp.filter(F.col("split") == "val"), ["imputation"])
    return B.best_stack_prediction(s.filter(F.col("split") == "test"), MEMBERS, val)


@register("b11_rule_baseline", f"""WITH d AS {DW}, m AS (SELECT doc_id AS id, ({' + '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0)' for c in BIN)}) / {len(BIN)} AS rm FROM d),
q AS (SELECT quantile_cont(rm, 0.7) AS t FROM m)
SELECT id, {r6('rm')} AS row_mean, CAST(rm >= t AS INTEGER) AS prediction FROM m, q""")
def b11(spark, sf_dir):
    return B.rule_baseline(T.doc_wide(spark, sf_dir).withColumnRenamed("doc_id", "id"), BIN, 0.7, "id")


@register("b12_stream_scoring")
def b12(spark, sf_dir):
    """New rows arrive as Parquet files; the streaming query scores every micro-batch with the
    frozen preparation and models, appending to a sink that is read back."""
    from adlytics.streaming.stream import score_stream
    prep, models, incoming = _fit_models(spark, sf_dir)
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    incoming.repartition(3).write.parquet(f"{base}/in")
    q = score_stream(spark, f"{base}/in", incoming.schema, f"{base}/out", f"{base}/ckpt", prep, models, "doc_id")
    q.awaitTermination(600)
    return spark.read.parquet(f"{base}/out")
