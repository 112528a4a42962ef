"""Source/sink (S1-S15) and cleaning (P1-P17) queries.

Delimited-text queries first write a dirty copy of the wide document table (quoted names,
'?' for NULL, a duplicated ``.1`` column, label text) into a fresh folder under the shared
checkpoint folder, then read it back through the library's readers and cleaners.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.operators import clean as P
from adlytics.operators import missing as M
from adlytics.session import scratch_path
from adlytics.sources import io as S

DW = T.doc_wide_sql()
DL = T.doc_labelled_sql()
BIN = T.doc_binary_cols()
CONT = T.DOC_CONT
FEATS = CONT + ["X4"] + BIN
TYPES = {"doc_id": "bigint", "y": "int", **{c: "double" for c in CONT}, **{c: "int" for c in ["X4"] + BIN}}


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


def _dirty(spark, sf_dir):
    """Dirty text version: quoted header names, label text, X2 duplicated as X2.1 (dropped on
    read), the last flag renamed with a .1 suffix (promoted back on read)."""
    dw = T.doc_wide(spark, sf_dir)
    last = BIN[-1]
    cols = [F.col("doc_id").alias('"doc_id"'),
            F.when(F.col("y") == 1, F.lit(" Ad. ")).when(F.col("y") == 0, F.lit("noad.")).alias("outcome")]
    cols += [F.col(c).alias(f'"{c}"') for c in FEATS if c != last]
    cols += [F.col("X2").alias("X2.1"), F.col(last).alias(f"{last}.1")]
    return dw.select(*cols)


def _typed(df):
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in TYPES.items()])


_DW_SQL = f"SELECT * FROM {DL} d"


@register("s01_read_delimited_sep_fallback", _DW_SQL)
def s01(spark, sf_dir):
    path = _fresh(spark, "s01")
    labelled = _dirty(spark, sf_dir).filter("outcome IS NOT NULL")
    labelled.write.option("header", True).option("escape", '"').option("nullValue", "?").csv(path)  # comma
    df = S.read_delimited(spark, path, null_value="?")          # tab tried first, then comma
    df = S.require_columns(df, ["outcome"])
    return _typed(P.encode_target(df, "outcome", "y"))


@register("s02_read_test_file", f"SELECT * EXCLUDE (y) FROM {DW} d")
def s02(spark, sf_dir):
    path = _fresh(spark, "s02")
    _dirty(spark, sf_dir).drop("outcome").write.option("header", True).option("escape", '"').option("sep", "\t") \
        .option("nullValue", "?").csv(path)
    df = S.read_delimited(spark, path, null_value="?", malformed="DROPMALFORMED")
    return _typed(df.withColumn("y", F.lit(0))).drop("y")


@register("s03_row_ids", "SELECT CAST(unnest(range(1, (SELECT count(*) + 1 FROM documents))) AS BIGINT) AS \"ID\"")
def s03(spark, sf_dir):
    path = _fresh(spark, "s03")
    _dirty(spark, sf_dir).drop("outcome").write.option("header", True).option("escape", '"').option("sep", "\t") \
        .option("nullValue", "?").csv(path)
    return S.with_row_ids(S.read_delimited(spark, path, null_value="?"), "ID", 1).select("ID")


@register("s05_shape_report", f"""WITH n AS (SELECT count(*) AS d, (SELECT count(*) FROM labels) AS l FROM documents)
SELECT 'documents' AS expected, d AS n_rows, {len(TYPES)} AS n_cols, true AS matches FROM n
UNION ALL SELECT 'labels', d, {len(TYPES)}, d = l FROM n UNION ALL SELECT 'columns', d, {len(TYPES)}, false FROM n""")
def s05(spark, sf_dir):
    """The shape against the documents' rows, the labels' rows, and one column too many."""
    dw = T.doc_wide(spark, sf_dir)
    rows = {t: T.read(spark, sf_dir, t).count() for t in ("documents", "labels")}
    asked = [("documents", rows["documents"], len(TYPES)), ("labels", rows["labels"], len(TYPES)), ("columns", rows["documents"], len(TYPES) + 1)]
    return reduce(lambda a, b: a.unionByName(b), [S.shape_report(dw, n, c).withColumn("expected", F.lit(e)) for e, n, c in asked])


@register("s04_required_columns", """SELECT 'doc_id,y' AS required, CAST(NULL AS VARCHAR) AS error, (SELECT count(*) FROM documents) AS n_rows
UNION ALL SELECT 'doc_id,outcome', 'missing required columns: [''outcome'']', NULL""")
def s04(spark, sf_dir):
    """A table with its required columns, and one without."""
    rows = []
    for need in (["doc_id", "y"], ["doc_id", "outcome"]):
        try:
            rows.append((",".join(need), None, S.require_columns(T.doc_wide(spark, sf_dir), need).count()))
        except ValueError as e:
            rows.append((",".join(need), str(e), None))
    return spark.createDataFrame(rows, "required string, error string, n_rows long")


@register("s06_variant_partitions", """SELECT doc_id, toxic AS y, 'median' AS variant FROM documents
  LEFT JOIN labels USING (doc_id)""")
def s06(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    root = _fresh(spark, "s06")
    both = dw.select("doc_id", "y", F.lit("raw").alias("variant")).unionByName(
        M.median_fill(dw, CONT).select("doc_id", "y", F.lit("median").alias("variant")))
    S.write_table(both, root, "parquet", partition_by=["variant"])
    return S.discover_variants(spark, root).filter(F.col("variant") == "median").select("doc_id", "y", "variant")


@register("s07_s08_s10_roundtrip", f"SELECT doc_id, y, X1, X2, X3 FROM {DW} d")
def s07(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir).select("doc_id", "y", *CONT)
    base = _fresh(spark, "s07")
    pq = S.write_table(dw, os.path.join(base, "t.parquet"))
    cs = S.write_table(S.read_table(spark, pq), os.path.join(base, "t.csv"))
    js = S.write_table(S.read_table(spark, cs), os.path.join(base, "t.json"))
    back = S.read_table(spark, js)
    return back.select(F.col("doc_id").cast("bigint"), F.col("y").cast("int"),
                       *[F.col(c).cast("double") for c in CONT])


@register("s09_export_formats", f"""WITH d AS {DW}, f AS (SELECT * FROM (VALUES ('parquet'), ('csv')) AS f(format))
SELECT 'wide' AS dataset, format, count(*) AS n_rows, count(X1) AS n_x1 FROM d, f GROUP BY format
UNION ALL SELECT 'wide_median', format, count(*), count(*) FROM d, f GROUP BY format""")
def s09(spark, sf_dir):
    """Every dataset in every format, counted from the files."""
    dw = T.doc_wide(spark, sf_dir)
    listing = S.export_formats({"wide": dw, "wide_median": M.median_fill(dw, CONT)}, _fresh(spark, "s09"))
    back = [S.read_table(spark, r["path"]).agg(F.count(F.lit(1)).alias("n_rows"), F.count("X1").alias("n_x1"))
            .select(F.lit(r["dataset"]).alias("dataset"), F.lit(r["format"]).alias("format"), "n_rows", "n_x1") for r in listing.collect()]
    return reduce(lambda a, b: a.unionByName(b), back)


@register("s11_s12_thresholds_json")
def s11(spark, sf_dir):
    """Threshold results written as a JSON map per variant, read back as tagged rows."""
    from adlytics.operators import metrics as E
    s = T.scores(spark, sf_dir).filter(F.col("split") == "val")
    th = E.exact_threshold_search(s, ["imputation", "model"])
    base = _fresh(spark, "s11")
    out = None
    for imp in ("knn", "mice"):
        m = th.filter(F.col("imputation") == imp).agg(F.map_from_entries(F.collect_list(F.struct(
            "model", F.struct("threshold", "f1", "precision", "recall")))).alias("m"))
        path = os.path.join(base, imp)
        m.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
        r = S.read_thresholds_json(spark, path, imp, "full")
        out = r if out is None else out.unionByName(r)
    return out


@register("s13_comparison_table", f"""WITH s AS {T.scores_sql()},
m AS (SELECT split, imputation, model, count_if(p >= 0.5 AND y = 1) AS tp, count_if(p >= 0.5 AND y = 0) AS fp,
  count_if(p < 0.5 AND y = 1) AS fn FROM s WHERE split IN ('val', 'test') GROUP BY 1, 2, 3)
SELECT imputation, model, CASE split WHEN 'val' THEN 'validation' ELSE 'by file name' END AS label,
  {r6('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END')} AS score FROM m""")
def s13(spark, sf_dir):
    from adlytics.operators import metrics as E
    s = T.scores(spark, sf_dir)
    base = _fresh(spark, "s13")
    paths = []
    for split in ("val", "test"):
        m = E.metrics_at_threshold(s.filter(F.col("split") == split), 0.5, ["imputation", "model"])
        p = os.path.join(base, split)
        S.write_results_json(m.withColumnRenamed("f1", f"{split}_f1"), p)
        paths.append(p)
    # a label for the validation files only: the others show their own names, the source that is known
    files = spark.read.json(paths[0]).select(F.col("_metadata.file_name").alias("file")).distinct()
    details = files.withColumn("label", F.lit("validation"))
    return S.comparison_from_files(spark, paths, details).select(
        "imputation", "model", F.when(F.col("label") == "validation", F.col("label")).otherwise("by file name").alias("label"), "score")


@register("s15_batch_process", """SELECT 'wide' AS dataset, 'ok' AS status, (SELECT count(*) FROM documents) AS n_rows
UNION ALL SELECT 'no_x1', 'failed', NULL UNION ALL SELECT 'bad_cell', 'failed', NULL""")
def s15(spark, sf_dir):
    """Three data sets, one without a column and one whose job fails on a cell: the third is whole."""
    dw = T.doc_wide(spark, sf_dir)
    bad = dw.withColumn("X2", F.when(F.col("doc_id") % 10 == 3, F.lit("x")).otherwise(F.lit("1")).cast("double"))
    outs, status = S.batch_process({"wide": dw, "no_x1": dw.drop("X1"), "bad_cell": bad},
                                   lambda d: M.fill_values(P.strict_align(d, FEATS, ["doc_id", "y"]), {"X1": 0.0}))
    n = F.lit(outs["wide"].count())
    return status.select("dataset", "status", F.when(F.col("status") == "ok", n).alias("n_rows"))


# ------------------------------------------------------------------ P
@register("p02_clean_strings", r"""SELECT conv_id, turn, role,
  regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '"', '', 'g') AS text FROM conversations""")
def p02(spark, sf_dir):
    return P.clean_string_values(T.read(spark, sf_dir, "conversations"))


_LABEL_TXT = "CASE WHEN toxic = 1 THEN ' Ad. ' ELSE 'noad.' END"


@register("p04_encode_label", "SELECT doc_id, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS y FROM labels")
def p04(spark, sf_dir):
    lab = T.read(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, F.lit(" Ad. ")).otherwise(F.lit("noad.")).alias("outcome"))
    return P.encode_target(lab, "outcome", "y")


@register("p05_decode_label", "SELECT doc_id, toxic AS y, CASE WHEN toxic = 1 THEN 'ad.' ELSE 'noad.' END AS label FROM labels")
def p05(spark, sf_dir):
    return P.decode_target(T.read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("y")), "y", "label")


@register("p06_coerce_numeric", """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS p_size,
  CAST(0.0 AS DOUBLE) AS p_name FROM part""")
def p06(spark, sf_dir):
    part = T.read(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("\""), F.when(F.col("p_partkey") % 7 == 0, F.lit("12 pieces")).otherwise(F.col("p_size").cast("string")),
                              F.lit("'")).alias("p_size"),
        F.col("p_name"))
    return P.coerce_numeric(part, ["p_size", "p_name"], fill=0.0)


@register("p07_align_columns", f"SELECT doc_id, X1, X5, 0 AS X999, X4 FROM {DW} d")
def p07(spark, sf_dir):
    return P.align_columns(T.doc_wide(spark, sf_dir), ["X1", "X5", "X999", "X4"], fill=0, keep=["doc_id"])


@register("p08_keep_present", f"SELECT X1, X4 FROM {DW} d")
def p08(spark, sf_dir):
    return P.keep_present(T.doc_wide(spark, sf_dir), ["X1", "X0", "X4", "X998"])


@register("p09_strict_align", f"SELECT doc_id, y, {', '.join(FEATS)} FROM {DW} d")
def p09(spark, sf_dir):
    return P.strict_align(T.doc_wide(spark, sf_dir), FEATS, keep=["doc_id", "y"])


@register("p10_to_int_if_binary", f"SELECT doc_id, X4 FROM {DW} d")
def p10(spark, sf_dir):
    d = T.doc_wide(spark, sf_dir).select("doc_id", F.col("X4").cast("double").alias("X4"))
    return P.to_int_if_binary(d, "X4")


@register("p11_median_fill_int", f"""WITH d AS {DW}
SELECT doc_id, CAST(trunc(coalesce(CAST(X4 AS DOUBLE), (SELECT quantile_cont(X4, 0.5) FROM d))) AS INTEGER) AS X4 FROM d""")
def p11(spark, sf_dir):
    return M.median_fill_int(T.doc_wide(spark, sf_dir).select("doc_id", "X4"), "X4")


@register("p12_finalize_transformed", f"SELECT doc_id, {r6('ln(1 + X1)')} AS X1, X2 FROM {DW} d")
def p12(spark, sf_dir):
    d = T.doc_wide(spark, sf_dir).select("doc_id", "X1", "X2")
    d = d.withColumn("X1_trans", F.round(F.log1p("X1"), 6) + 0.0)
    return P.finalize_transformed(d, ["X1"], "_trans", rename=True)


@register("p13_reorder_priority", f"SELECT X4, y, doc_id, X1 FROM {DW} d")
def p13(spark, sf_dir):
    return P.reorder_priority(T.doc_wide(spark, sf_dir).select("doc_id", "X1", "y", "X4"), ["X4"], "y")


@register("p14_dedupe_columns", f"SELECT doc_id, X1 FROM {DW} d")
def p14(spark, sf_dir):
    d = T.doc_wide(spark, sf_dir).select("doc_id", "X1", "X2")
    return P.dedupe_columns(d.toDF("doc_id", "X1", "X1"))


@register("p15_mask_selector", f"SELECT doc_id, {', '.join(c for i, c in enumerate(BIN) if i % 3 == 0)} FROM {DW} d")
def p15(spark, sf_dir):
    sel = P.ColumnMaskSelector(inputCols=BIN, mask=[i % 3 == 0 for i in range(len(BIN))], keep=["doc_id"])
    return sel.transform(T.doc_wide(spark, sf_dir))


@register("p16_sanitize_numeric", f"""SELECT doc_id, {', '.join(f'CASE WHEN doc_id % 11 IN (1, 2, 3) THEN 0.0 ELSE coalesce({c}, 0.0) END AS {c}' for c in CONT)}
FROM {DW} d""")
def p16(spark, sf_dir):
    """NaN and both infinities in three of eleven rows, NULLs elsewhere."""
    k = F.col("doc_id") % 11
    odd = lambda c: F.when(k == 1, float("nan")).when(k == 2, float("inf")).when(k == 3, float("-inf")).otherwise(F.col(c))
    return P.sanitize_numeric(T.doc_wide(spark, sf_dir).select("doc_id", *[odd(c).alias(c) for c in CONT]))


@register("p17_predict_at_threshold", f"""SELECT id, imputation, model, CAST(p >= 0.5 AS INTEGER) AS pred
FROM {T.scores_sql()} s""")
def p17(spark, sf_dir):
    return P.predict_at(T.scores(spark, sf_dir), "p", 0.5).select("id", "imputation", "model", "pred")
