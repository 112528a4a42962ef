"""Bindings of the library's input shapes to the given test tables.

Each builder only shapes rows into the schema an operator expects (FIXTURES.md section C);
the operators do all the work. Every builder has an SQL twin with the same rule, used by the
DuckDB oracle. Rules use integer arithmetic on keys so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.functions.exprs import HASH_MOD, portable_hash, portable_hash_sql
from adlytics.session import cut_lineage


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------------------------
# lineitem with induced nulls: a large table with a binary target (l_returnflag = 'R')
# --------------------------------------------------------------------------------------------
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "price_unit"]

# (l_orderkey, l_linenumber, l_partkey, l_suppkey) is the unique row key of the test lineitem;
# packed into one integer (l_partkey < 2^21, l_suppkey < 2^14 at the test scales).
LINE_ID_SQL = "((l_orderkey * 8 + l_linenumber) * 2097152 + l_partkey) * 16384 + l_suppkey"


def line_id():
    """``LINE_ID_SQL`` as a 64-bit integer. From order key 2^25 on its last product leaves the signed
    range, which is an error as a multiplication; shifted, the upper half of the 64 bits is used too
    (negative ids), so ids stay apart for order keys below 2^26."""
    supp = F.col("l_suppkey").cast("long")
    upper = (F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")) * 2097152 + F.col("l_partkey") + F.shiftright(supp, 14)
    return F.shiftleft(upper, 14).bitwiseOR(supp.bitwiseAND(F.lit(16383).cast("long")))


def lineitem_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    null = F.lit(None).cast("double")
    return li.select(
        line_id().alias("id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        F.col("l_returnflag"),
        F.when(k % 4 == 0, null).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(k % 10 == 0, null).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(k % 3 != 0, null).otherwise(F.col("l_discount")).alias("l_discount"),
        F.col("l_tax"),
        F.when((k % 4 == 0) | (k % 10 == 0) | (F.col("l_quantity") == 0), null)
         .otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("price_unit"),
    )


LINEITEM_NULLS_SQL = f"""(SELECT {LINE_ID_SQL} AS id,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  l_returnflag,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN l_orderkey % 3 <> 0 THEN NULL ELSE l_discount END AS l_discount,
  l_tax,
  CASE WHEN l_orderkey % 4 = 0 OR l_orderkey % 10 = 0 OR l_quantity = 0 THEN NULL
       ELSE l_extendedprice / l_quantity END AS price_unit
FROM lineitem)"""


# --------------------------------------------------------------------------------------------
# events: skewed positive continuous value, target = purchase
# --------------------------------------------------------------------------------------------
def events_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("user_id"),
                     F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"),
                     F.col("value"))


EVENTS_TARGET_SQL = """(SELECT event_id AS id, user_id,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, value FROM events)"""


# --------------------------------------------------------------------------------------------
# Wide sparse table like the reference's training file: documents, with labels where there are any
# X1 = n_chars, X2 = word count, X3 = X1/X2, X4 = (lang='en'), X5.. = top-token presence,
# y = toxic, NULL for an unlabelled document. Nulls induced on X1..X4 by key rules.
# --------------------------------------------------------------------------------------------
N_TOKENS = 40
TOKEN_RE = r"\p{L}+"


def doc_tokens(docs: DataFrame) -> DataFrame:
    return docs.withColumn("tokens", F.regexp_extract_all(F.lower(F.col("text")), F.lit(TOKEN_RE), 0))


def top_tokens(tok_docs: DataFrame, n: int) -> list[str]:
    """The n tokens present in most documents (ties by token), as a driver list of n names."""
    df = (tok_docs.select(F.explode(F.array_distinct("tokens")).alias("t"))
          .groupBy("t").agg(F.count(F.lit(1)).alias("df"))
          .orderBy(F.col("df").desc(), F.col("t")).limit(n))
    return [r["t"] for r in df.collect()]


def doc_wide(spark: SparkSession, sf_dir: str, n_tokens: int = N_TOKENS) -> DataFrame:
    """The wide table, written once: nearly every operator reads it several times, and would cut
    the texts into tokens again each time. The labels are joined to the finished rows, so no text
    is shuffled."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("y"))
    docs = read(spark, sf_dir, "documents")
    # a document counts once per row it has in the table
    again = labels.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    toks = top_tokens(doc_tokens(docs if again.isEmpty() else docs.join(labels, "doc_id", "left")), n_tokens)
    docs = doc_tokens(docs)
    if toks:
        # the flags look through the few tokens found instead of all tokens of a text
        docs = docs.withColumn("found", F.array_intersect("tokens", F.array(*map(F.lit, toks))))
    k = F.col("doc_id")
    null = F.lit(None).cast("double")
    wc = F.size("tokens").cast("double")
    cols = [
        k.alias("doc_id"),
        F.when(k % 4 == 0, null).otherwise(F.col("n_chars").cast("double")).alias("X1"),
        F.when(k % 4 == 1, null).otherwise(wc).alias("X2"),
        F.when((k % 4 == 2) | (wc == 0), null).otherwise(F.col("n_chars") / wc).alias("X3"),
        F.when(k % 97 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("lang") == "en").cast("int")).alias("X4"),
    ]
    for i, t in enumerate(toks):
        cols.append(F.array_contains("found", t).cast("int").alias(f"X{5 + i}"))
    rows = docs.select(*cols)
    return cut_lineage(rows.join(labels, "doc_id", "left").select("doc_id", "y", *rows.columns[1:]))


def doc_wide_sql(n_tokens: int = N_TOKENS) -> str:
    flags = ",\n  ".join(
        f"CAST(list_contains(d.tokens, (SELECT t FROM top_tok WHERE rk = {i + 1})) AS INTEGER) AS X{5 + i}"
        for i in range(n_tokens))
    return f"""(WITH dl AS (
  SELECT d.doc_id, d.n_chars, d.lang, l.toxic,
         regexp_extract_all(lower(d.text), '{TOKEN_RE}') AS tokens
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
tok AS (SELECT DISTINCT doc_id, unnest(tokens) AS t FROM dl),
top_tok AS (SELECT t, row_number() OVER (ORDER BY count(*) DESC, t) AS rk FROM tok GROUP BY t)
SELECT d.doc_id, d.toxic AS y,
  CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE CAST(d.n_chars AS DOUBLE) END AS X1,
  CASE WHEN d.doc_id % 4 = 1 THEN NULL ELSE CAST(len(d.tokens) AS DOUBLE) END AS X2,
  CASE WHEN d.doc_id % 4 = 2 OR len(d.tokens) = 0 THEN NULL
       ELSE d.n_chars / CAST(len(d.tokens) AS DOUBLE) END AS X3,
  CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE CAST(d.lang = 'en' AS INTEGER) END AS X4,
  {flags}
FROM dl d)"""


def doc_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a label, for training and for statistics of the target."""
    return doc_wide(spark, sf_dir).filter(F.col("y").isNotNull())


def doc_labelled_sql() -> str:
    return f"(SELECT * FROM {doc_wide_sql()} dl WHERE y IS NOT NULL)"


DOC_CONT = ["X1", "X2", "X3"]


def doc_binary_cols(n_tokens: int = N_TOKENS) -> list[str]:
    return [f"X{5 + i}" for i in range(n_tokens)]


# --------------------------------------------------------------------------------------------
# Score table like the reference's model outputs: (id, split, imputation, version, model, y, p)
# p = round(1/(1+exp(-(a + b*(y-0.5) + c*(u-0.5)))), 4), u a portable hash of the key.
# --------------------------------------------------------------------------------------------
# Score generators (imputation, model, a, b, c, seed)
SCORE_MODELS = [
    ("knn", "gradboost", -1.0, 3.0, 4.0, 11),
    ("knn", "randforest", -0.8, 2.5, 3.0, 13),
    ("knn", "svm", -1.2, 2.0, 5.0, 17),
    ("knn", "mlp", -0.6, 1.5, 3.5, 19),
    ("knn", "xgboost", -1.0, 2.8, 4.5, 23),
    ("mice", "gradboost", -1.1, 3.2, 4.0, 29),
    ("mice", "randforest", -0.7, 2.2, 3.0, 31),
    ("mice", "svm", -1.3, 2.1, 5.0, 37),
    ("mice", "mlp", -0.5, 1.4, 3.5, 41),
    ("mice", "xgboost", -0.9, 2.9, 4.5, 43),
]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        line_id().alias("id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    models = F.array(*[F.struct(F.lit(i).alias("imputation"), F.lit(m).alias("model"),
                                F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c"),
                                F.lit(s).cast("long").alias("seed"))
                       for i, m, a, b, c, s in SCORE_MODELS])
    u = portable_hash("id", F.col("m.seed")) / float(HASH_MOD)
    # the split is hashed once per row, before the models
    su = portable_hash("id", 7) / float(HASH_MOD)
    split = F.when(su < 0.6, "train").when(su < 0.8, "val").otherwise("test")
    z = F.col("m.a") + F.col("m.b") * (F.col("y") - 0.5) + F.col("m.c") * (u - 0.5)
    return (li.select("id", "y", split.alias("split"), F.explode(models).alias("m"))
            .select("id", "split",
                    F.col("m.imputation").alias("imputation"), F.lit("full").alias("version"),
                    F.col("m.model").alias("model"), "y",
                    F.round(1.0 / (1.0 + F.exp(-z)), 4).alias("p")))


def scores_sql() -> str:
    vals = ", ".join(f"('{i}', '{m}', {a}, {b}, {c}, {s})" for i, m, a, b, c, s in SCORE_MODELS)
    return f"""(SELECT id,
  CASE WHEN {portable_hash_sql('id', 7)} / {float(HASH_MOD)} < 0.6 THEN 'train'
       WHEN {portable_hash_sql('id', 7)} / {float(HASH_MOD)} < 0.8 THEN 'val'
       ELSE 'test' END AS split,
  imputation, 'full' AS version, model, y,
  round(1.0 / (1.0 + exp(-(a + b * (y - 0.5) + c * ({portable_hash_sql('id', 'seed')} / {float(HASH_MOD)} - 0.5)))), 4) AS p
FROM (SELECT {LINE_ID_SQL} AS id,
             CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem) li
CROSS JOIN (VALUES {vals}) AS m(imputation, model, a, b, c, seed))"""
