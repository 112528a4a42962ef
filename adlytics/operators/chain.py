"""Chained-equation imputation with any ``pyspark.ml`` regressor, saved and replayed as models (M4).

Missing cells start at the column means. Each round takes the incomplete columns by ascending
number of missing cells, fits a regressor of the column on all others over the rows that have it,
and replaces the missing cells by its predictions. The fitted chain is the list of those models in
order; replaying it on new rows needs no statistic of theirs.

Only rows with a missing cell change: complete rows are written once and read by every fit, the
others are written each round.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.functions.exprs import col
from adlytics.operators.common import melt
from adlytics.session import cut_lineage

CUT_EVERY = 12            # models replayed between two lineage cuts
MIN_COMPLETE = 10


def ridge(reg: float = 1e-6) -> Callable:
    """Least squares with a small ridge, solved exactly."""
    return lambda: LinearRegression(regParam=reg, solver="normal")


def boosted(seed: int = 42, **params) -> Callable:
    """Gradient-boosted trees; 300 trees of depth 4 at step 0.03 on 80 % of the rows by default."""
    settings = {"maxIter": 300, "stepSize": 0.03, "maxDepth": 4, "minInstancesPerNode": 5, "subsamplingRate": 0.8, **params}
    return lambda: GBTRegressor(seed=seed, **settings)


def _pipeline(regressor, target: str, cols: list[str]) -> Pipeline:
    feats = [c for c in cols if c != target]
    est = regressor.copy().setParams(featuresCol="_x", labelCol="_y", predictionCol="_p")
    return Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="_x"), est])


def _start(df: DataFrame, cols: list[str], means: dict) -> DataFrame:
    """The columns as doubles with the means in the missing cells, and ``_gone``: where they were."""
    gone = F.array(*[col(c).isNull() for c in cols]).alias("_gone")
    return df.select(*[F.coalesce(col(c).cast("double"), F.lit(means[c])).alias(c) if c in cols else col(c) for c in df.columns], gone)


def _step(state: DataFrame, model: PipelineModel, c: str, cols: list[str]) -> DataFrame:
    """``state`` with the predictions in the cells of ``c`` that were missing."""
    names = state.columns
    out = model.transform(state)
    return out.select(*[F.when(F.col("_gone")[cols.index(c)], F.col("_p")).otherwise(col(c)).alias(c) if n == c else col(n)
                        for n in names])


@dataclass
class FittedChain:
    cols: list[str]
    means: dict
    steps: list[tuple[str, PipelineModel]] = field(default_factory=list)
    rounds: int = 0
    converged: bool = False

    def transform(self, df: DataFrame, id_col: str) -> DataFrame:
        """``df`` with its missing cells imputed by the fitted chain; other cells are as they were,
        as doubles. A column without any training value stays missing."""
        open_rows = _start(df, self.cols, self.means)
        some = F.exists("_gone", lambda g: g)
        whole, state = open_rows.filter(~some).drop("_gone"), cut_lineage(open_rows.filter(some))
        for i, (c, model) in enumerate(self.steps):
            state = _step(state, model, c, self.cols)
            if (i + 1) % CUT_EVERY == 0:
                state = cut_lineage(state)
        return whole.unionByName(state.drop("_gone"))

    def save(self, spark: SparkSession, folder: str) -> str:
        """One folder: the models by their place in the chain, and the rest as JSON."""
        for i, (_, model) in enumerate(self.steps):
            model.write().overwrite().save(f"{folder}/steps/{i:05d}")
        rest = {"cols": self.cols, "means": self.means, "steps": [c for c, _ in self.steps], "rounds": self.rounds, "converged": self.converged}
        spark.createDataFrame([(json.dumps(rest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/chain")
        return folder

    @staticmethod
    def load(spark: SparkSession, folder: str) -> "FittedChain":
        rest = json.loads(spark.read.text(f"{folder}/chain").first()[0])
        steps = [(c, PipelineModel.load(f"{folder}/steps/{i:05d}")) for i, c in enumerate(rest["steps"])]
        return FittedChain(rest["cols"], rest["means"], steps, rest["rounds"], rest["converged"])


def fit_chain(df: DataFrame, cols: list[str], id_col: str, regressor: Callable = ridge(), max_iter: int = 10,
              tol: float = 1e-3, min_complete: int = MIN_COMPLETE) -> FittedChain:
    """Fits the chain on ``df`` (M4). ``regressor``: makes a fresh estimator, or a dict of makers by
    column. A round ends the search when no imputed cell changes by more than ``tol`` times the
    largest observed |value|. Fewer than ``min_complete`` complete rows are an error."""
    if df.na.drop(subset=cols).limit(min_complete).count() < min_complete:
        raise ValueError("not enough complete rows for chained-equation imputation")
    stats = {r["column"]: r for r in melt(df, cols).groupBy("column").agg(
        F.avg("value").alias("mean"), F.max(F.abs("value")).alias("top"), F.count_if(F.col("value").isNull()).alias("gone")).collect()}
    chain = FittedChain(list(cols), {c: stats[c]["mean"] for c in cols})
    order = [c for c in sorted(cols, key=lambda c: (stats[c]["gone"], cols.index(c))) if stats[c]["gone"]]
    scale = max([stats[c]["top"] or 0.0 for c in cols] + [1e-12])
    rows = _start(df.select(id_col, *cols), cols, chain.means)
    some = F.exists("_gone", lambda g: g)
    whole, state = cut_lineage(rows.filter(~some)), cut_lineage(rows.filter(some))
    for _ in range(max_iter):
        before = state
        for c in order:
            maker = regressor[c] if isinstance(regressor, dict) else regressor
            seen = whole.union(state.filter(~F.col("_gone")[cols.index(c)])).withColumn("_y", col(c))
            model = _pipeline(maker(), c, cols).fit(seen)
            chain.steps.append((c, model))
            state = _step(state, model, c, cols)
        state = cut_lineage(state)
        chain.rounds += 1
        if not order:
            break
        old = before.select(col(id_col).alias("_id"), *[col(c).alias(f"_old_{c}") for c in order])
        change = state.join(old, state[id_col] == old["_id"]).agg(
            F.max(F.greatest(F.lit(0.0), *[F.abs(col(c) - F.col(f"_old_{c}")) for c in order]))).first()[0] or 0.0
        if change < tol * scale:
            chain.converged = True
            break
    return chain
