"""Additive attribution of tree ensembles to their features, for every row of a table (L-18).

The game is the path-dependent one: a tree's value for a set S of known features follows the row at
splits on features of S and averages both children, weighted by their training rows, at the others.
A tree is a sum over its leaves, and a leaf of value v whose path splits on features F contributes

    v * prod over g in F of (o_g if g in S else z_g),

with o_g = 1 if the row passes all splits on g of that path (else 0) and z_g the product of the
children's shares at those splits. The Shapley value of f in such a product is

    v * (o_f - z_f) * sum_k k! (m - 1 - k)! / m! * [y^k] prod over g <> f of (z_g + o_g y),   m = |F|,

so each leaf costs a few products per row, whatever the number of features of the table. Values add
up: the expected value plus all attributions of a row is the ensemble's margin. Rows are scored in
Arrow batches with the flat leaf table, which a saved model's node table gives.
"""

from __future__ import annotations

import math
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.functions.exprs import col
from adlytics.session import scratch_path

# tasks get the functions themselves, not an import of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, weight, id, value, rows, left, right, feature, cut): the nodes of a fitted ensemble.

    ``value`` is what a leaf adds: the prediction times the tree's weight for boosted trees, the
    share of class 1 over the number of trees for a forest. Splits on categories are refused."""
    path = scratch_path(spark, f"trees-{uuid.uuid4().hex[:10]}")
    model.write().save(path)
    n = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    w = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "meta", "weight").select("tree", "weight")
    if isinstance(model, GBTClassificationModel):
        value = F.col("prediction") * F.col("weight")
    elif isinstance(model, RandomForestClassificationModel):
        value = F.col("impurityStats")[1] / F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x) / len(model.trees)
    else:
        raise ValueError(f"no attribution for {type(model).__name__}")
    n = n.join(F.broadcast(w), n["treeID"] == w["tree"])       # one row per tree
    if not n.filter("split.numCategories >= 0").isEmpty():
        raise ValueError("splits on categories have no order to attribute")
    return n.select("tree", F.col("id"), value.alias("value"), F.col("rawCount").alias("rows"), F.col("leftChild").alias("left"),
                    F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("feature"),
                    F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"))


class Leaves:
    """Leaves as (value, features, low, high, share): a row passes a feature's splits on the path if
    low < x <= high."""

    def __init__(self, nodes: list):
        self.leaves = []
        by_tree: dict[int, dict[int, dict]] = {}
        for r in nodes:
            by_tree.setdefault(r["tree"], {})[r["id"]] = r
        for tree in by_tree.values():
            stack = [(tree[0], {})]
            while stack:
                node, path = stack.pop()
                if node["left"] < 0:
                    f = np.array(sorted(path), np.int64)
                    lo, hi, z = (np.array([path[j][k] for j in f], float) for k in range(3))
                    self.leaves.append((float(node["value"]), f, lo, hi, z))
                    continue
                lo, hi, z = path.get(node["feature"], (-math.inf, math.inf, 1.0))
                for child, bounds in ((tree[node["left"]], (lo, min(hi, node["cut"]))), (tree[node["right"]], (max(lo, node["cut"]), hi))):
                    share = child["rows"] / node["rows"]
                    stack.append((child, {**path, node["feature"]: (*bounds, z * share)}))
        self.expected = sum(v * float(np.prod(z)) for v, _, _, _, z in self.leaves)

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """Rows x features; a row's sum plus ``expected`` is its margin."""
        out = np.zeros(x.shape)
        for v, f, lo, hi, z in self.leaves:
            m = len(f)
            if not m:
                continue
            part = x[:, f]
            one = ((part > lo) & (part <= hi)).astype(float)
            for a in range(m):
                poly = np.zeros((len(x), m))
                poly[:, 0] = 1.0
                for g in range(m):
                    if g != a:
                        poly[:, 1:] = poly[:, 1:] * z[g] + poly[:, :-1] * one[:, g:g + 1]
                        poly[:, 0] *= z[g]
                weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
                out[:, f[a]] += v * (one[:, a] - z[a]) * (poly @ weight)
        return out


def tree_stage(model):
    """The tree ensemble of a fitted pipeline (or the model itself)."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    found = [s for s in stages if isinstance(s, (GBTClassificationModel, RandomForestClassificationModel))]
    if not found:
        raise ValueError("no tree ensemble in the model")
    return found[0]


def tree_attribution(model, df: DataFrame, id_col: str) -> tuple[DataFrame, float]:
    """((id, margin, attributions array<double>), expected value) for every row of ``df``.

    ``model``: a fitted pipeline with a tree ensemble, or the ensemble over a ``features`` column.
    ``margin`` is half the log odds of boosted trees, the class-1 probability of a forest. An
    empty table gives no rows; repeated rows repeat."""
    stage = tree_stage(model)
    leaves = Leaves(node_table(df.sparkSession, stage).collect())      # bounded by the ensemble's size
    x = df
    for s in model.stages if isinstance(model, PipelineModel) else []:
        if s is stage:
            break
        x = s.transform(x)
    x = x.select(col(id_col).alias("id"), vector_to_array(F.col(stage.getFeaturesCol())).alias("x"))

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            a = leaves.attributions(flat.reshape(len(batch), -1))
            off = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * a.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(a.sum(axis=1) + leaves.expected),
                 pa.ListArray.from_arrays(off, pa.array(a.reshape(-1)))], names=["id", "margin", "attributions"])

    out = x.mapInArrow(run, f"id {dict(x.dtypes)['id']}, margin double, attributions array<double>")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out, leaves.expected


def mean_attribution(attributed: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean_abs_attribution, mean_attribution) over all attributed rows."""
    long = attributed.select(F.posexplode("attributions").alias("pos", "a"))
    names = df_names(attributed.sparkSession, features)
    return long.groupBy("pos").agg(F.avg(F.abs("a")).alias("mean_abs_attribution"), F.avg("a").alias("mean_attribution")) \
        .join(F.broadcast(names), "pos").select("feature", "mean_abs_attribution", "mean_attribution")


def df_names(spark: SparkSession, features: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(features)), "pos int, feature string")
