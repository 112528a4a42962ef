"""Fitted preparation: fit every parameter on training data, replay it on new data.

Step order (the default follows the exploratory notebook; any order is a step list):
protected-column median -> imputation (median / knn / mice) -> power transforms (standardised)
-> IQR capping -> correlated-column drop list -> quadratic features of the transformed columns.

Every fitted value is metadata (medians, lambdas, bounds, names, coefficients); the kNN donors
are the training table itself, written once to the shared checkpoint folder. ``transform`` is a
projection plus, for kNN, the banded donor join.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col
from adlytics.operators import corr as C
from adlytics.operators import missing as M
from adlytics.operators import outliers as O
from adlytics.operators import transform as TR
from adlytics.operators.knn import knn_impute
from adlytics.operators.phi import phi_pairs
from adlytics.session import cut_lineage, scratch_path

LIBRARY_STEPS = ("protected", "power", "impute", "outliers", "reduce", "poly")
DEFAULT_STEPS = ("protected", "impute", "power", "cap", "reduce", "poly")


@dataclass
class FittedPrep:
    id_col: str
    target: str | None
    continuous: list[str]
    binary: list[str]
    protected: str | None = None
    protected_median: float | None = None
    impute: str = "median"
    k: int = 5
    medians: dict = field(default_factory=dict)
    mice: dict | None = None
    donors_path: str | None = None
    power: dict = field(default_factory=dict)          # column -> PowerFit as dict
    bounds: dict = field(default_factory=dict)         # column -> [lo, hi], capping
    fences: dict = field(default_factory=dict)         # column -> [lo, hi], removal
    drop: list = field(default_factory=list)
    poly: list = field(default_factory=list)
    steps: list = field(default_factory=lambda: list(DEFAULT_STEPS))
    suffix: str = "_transformed"
    columns: list = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "FittedPrep":
        return FittedPrep(**json.loads(s))

    def save(self, spark: SparkSession, path: str) -> str:
        """Parameter store (S14): one JSON document in shared storage."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedPrep":
        return FittedPrep.from_json(spark.read.text(path).first()[0])

    # ------------------------------------------------------------------ apply
    def _power(self) -> dict:
        return {c: TR.PowerFit(**v) for c, v in self.power.items()}

    def transform(self, df: DataFrame, remove_outliers: bool = False, strict: bool = False) -> DataFrame:
        """Frozen preprocessing of new rows (B1, T12): no statistic is recomputed.

        Rows outside the saved fences of an "outliers" step leave only with ``remove_outliers``
        (O4); at scoring every row stays by default. A prepared column that new rows cannot give is
        0, or with ``strict`` an error; the target may always be absent."""
        out = df
        for step in self.steps:
            if step == "protected" and self.protected and self.protected in out.columns:
                out = M.median_fill_int(out, self.protected, self.protected_median)
            elif step == "impute":
                out = self._impute(out)
            elif step == "power" and self.power:
                out = TR.apply_power(out, self._power(), self.suffix, keep=False)
            elif step == "outliers" and remove_outliers and self.fences:
                out = O.remove_outliers(out, list(self.fences), bounds={c: tuple(b) for c, b in self.fences.items()})
            elif step == "cap" and self.bounds:
                out = O.cap(out, {c: tuple(b) for c, b in self.bounds.items()})
            elif step == "reduce" and self.drop:
                out = C.apply_drop_list(out, self.drop, [self.protected] if self.protected else [])
            elif step == "poly" and self.poly:
                out = TR.quadratic_features(out, self.poly)
        if self.columns:
            present = set(out.columns)
            absent = [c for c in self.columns if c not in present and c != self.target]
            if strict and absent:
                raise ValueError(f"missing columns: {absent}")
            out = out.select(*[col(c) if c in present else F.lit(0).alias(c) for c in self.columns])
        return out

    def names_at(self, step: str) -> list[str]:
        """The continuous columns' names when ``step`` runs: transformed once the power step is past."""
        past = self.power and "power" in self.steps and self.steps.index("power") < self.steps.index(step)
        return [f"{c}{self.suffix}" if past and c in self.power else c for c in self.continuous]

    def _impute(self, df: DataFrame) -> DataFrame:
        cols = self.names_at("impute")
        if self.impute == "median":
            return M.median_fill(df, cols, self.medians)
        if self.impute == "mice":
            return M.mice_transform(df, self.mice)
        if self.impute == "knn":
            donors = df.sparkSession.read.parquet(self.donors_path)
            return knn_impute(df, cols, self.id_col, self.k, donors=donors)
        raise ValueError(f"unknown imputation {self.impute!r}")


def fit_prep(df: DataFrame, id_col: str, target: str | None, continuous: list[str], binary: list[str],
             protected: str | None = None, impute: str = "median", k: int = 5, power: str | dict = "yeo-johnson",
             cap: bool = True, corr_threshold: float | None = 0.9, poly: bool = True,
             steps=DEFAULT_STEPS, written: bool = False) -> tuple[DataFrame, FittedPrep]:
    """Fit every step on ``df`` (the training rows) and return (prepared df, FittedPrep).

    ``power`` is a method name for all continuous columns or {column: method}; a
    ``corr_threshold`` of None or >= 1 disables the reduction (the fallback ladder's last rung).
    ``written``: ``df`` is materialised already and is not written once more."""
    spark = df.sparkSession
    prep = FittedPrep(id_col=id_col, target=target, continuous=list(continuous), binary=list(binary),
                      protected=protected, impute=impute, k=k, steps=list(steps))
    # every fitting step scans its input several times: materialise it once, and again after
    # the imputation and transform steps (lineage stays short)
    out = df if written else cut_lineage(df)
    for step in steps:
        if step == "protected" and protected and protected in out.columns:
            prep.protected_median = M.fit_medians(out, [protected]).get(protected)
            out = M.median_fill_int(out, protected, prep.protected_median)
        elif step == "impute":
            cols = prep.names_at("impute")
            if impute == "median":
                prep.medians = M.fit_medians(out, cols)
                out = M.median_fill(out, cols, prep.medians)
            elif impute == "mice":
                out, prep.mice = M.mice_fit_transform(out, cols, id_col)
            elif impute == "knn":
                path = scratch_path(spark, f"donors-{uuid.uuid4().hex[:10]}")
                out.select(id_col, *cols).write.mode("overwrite").parquet(path)
                prep.donors_path = path
                out = knn_impute(out, cols, id_col, k, donors=spark.read.parquet(path))
            else:
                raise ValueError(f"unknown imputation {impute!r}")
            out = cut_lineage(out)
        elif step == "power" and power:
            if isinstance(power, str):
                fits = TR.fit_power(out, continuous, power, standardize=True)
            else:
                fits = {}
                for meth in set(power.values()):
                    fits.update(TR.fit_power(out, [c for c, m in power.items() if m == meth], meth, True))
            prep.power = {c: asdict(f) for c, f in fits.items()}
            out = TR.apply_power(out, fits, prep.suffix, keep=False)
        elif step == "outliers":
            cols = prep.names_at("outliers")
            prep.fences = {c: list(b) for c, b in O.iqr_bounds(out, cols).items()}
            out = cut_lineage(O.remove_outliers(out, cols, bounds={c: tuple(b) for c, b in prep.fences.items()}))
        elif step == "cap" and cap:
            cols = prep.names_at("cap")
            prep.bounds = {c: list(b) for c, b in O.iqr_bounds(out, cols).items()}
            out = O.cap(out, {c: tuple(b) for c, b in prep.bounds.items()})
        elif step == "reduce" and corr_threshold is not None and corr_threshold < 1.0 and binary:
            pairs = phi_pairs(out, [b for b in binary if b in out.columns], corr_threshold)
            drops = C.group_drops(pairs, [b for b in binary if b in out.columns], corr_threshold,
                                  protected=[protected] if protected else [])
            prep.drop = sorted(r["column"] for r in drops.select("column").distinct().collect())
            out = C.apply_drop_list(out, prep.drop, [protected] if protected else [])
        elif step == "poly" and poly:
            prep.poly = prep.names_at("poly")
            out = TR.quadratic_features(out, prep.poly)
    prep.columns = list(out.columns)
    return out, prep


def without_id(prep: FittedPrep, id_col: str) -> FittedPrep:
    """The same fitted plan for tables whose key is called ``id_col``."""
    return replace(prep, id_col=id_col, columns=[id_col if c == prep.id_col else c for c in prep.columns])


# The preset of the safe preparation and its fallback ladder (threshold 0.95, then
# 1.0 = no reduction).
SAFE_PRESET = {"impute": "median", "power": "yeo-johnson", "cap": True, "corr_threshold": 0.9, "poly": True}
FALLBACK_THRESHOLDS = (0.95, 1.0)


def prepare_safe(df: DataFrame, id_col: str, target: str, continuous: list[str], binary: list[str],
                 protected: str | None = None, **overrides):
    """Preset preparation with an explicit fallback ladder (T15). Returns (df, prep, status):
    status records which rung was used; a failure is never swallowed silently."""
    params = {**SAFE_PRESET, **overrides}
    rungs = [params["corr_threshold"], *FALLBACK_THRESHOLDS]
    errors = []
    for t in rungs:
        try:
            out, prep = fit_prep(df, id_col, target, continuous, binary, protected,
                                 **{**params, "corr_threshold": t})
            out.limit(1).count()
            return out, prep, f"ok(corr_threshold={t})" + ("" if not errors else f" after {errors}")
        except Exception as e:  # recorded and reported through status
            errors.append(f"{t}: {type(e).__name__}")
    raise RuntimeError(f"preparation failed on every rung: {errors}")


def smoke_report(df: DataFrame, id_col: str, target: str, continuous: list[str], binary: list[str],
                 protected: str | None = None) -> DataFrame:
    """Run a matrix of preparations and report pass/fail and the share passed."""
    runs = [("median", 0.9, True), ("median", 1.0, False), ("mice", 0.9, True),
            ("median", 0.95, True), ("knn", 0.9, True), ("median", None, True)]
    rows = []
    df = cut_lineage(df)                                 # once for all runs
    for impute, t, cap in runs:
        try:
            out, _ = fit_prep(df, id_col, target, continuous, binary, protected, impute=impute,
                              corr_threshold=t, cap=cap, written=True)
            n = out.count()
            rows.append((impute, t, cap, True, n, len(out.columns), None))
        except Exception as e:  # a failed run is a reported result
            rows.append((impute, t, cap, False, None, None, f"{type(e).__name__}: {e}"[:300]))
    spark = df.sparkSession
    rep = spark.createDataFrame(rows, "impute string, corr_threshold double, cap boolean, passed boolean, "
                                      "n_rows long, n_cols int, error string")
    return rep.withColumn("share_passed", F.avg(F.col("passed").cast("double")).over(Window.partitionBy()))
