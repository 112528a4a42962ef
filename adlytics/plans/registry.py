"""Stored candidates and the ladder that picks one (L-7, L-22, B3, B4, B7).

A registry is a folder of shared storage with one row per candidate: (model, imputation, version,
kind, path, columns, value). ``kind`` is a fitted pipeline, a set of tuned parameters or a
threshold. A request names a model and an imputation variant and, if it likes, a version; without
one the ladder is full, reduced, then the unversioned entry.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.operators import train as L

# Variants, model names with their aliases, and the versions in the order tried.
IMPUTATIONS = ("knn", "mice", "median")
ALIASES = {"gradientboosting": "gradboost", "randomforest": "randforest", "logreg": "lr"}
MODELS = (*L.FAMILIES, "lr", "stacking", "stacking_refit")
LADDER = ("full", "reduced", "")
SCHEMA = "model string, imputation string, version string, kind string, path string, columns array<string>, value string, added long"


def model_name(model: str) -> str:
    name = ALIASES.get(model.lower(), model.lower())
    if name not in MODELS:
        raise ValueError(f"unknown model {model!r}")
    return name


@dataclass
class Candidate:
    model: str
    imputation: str
    version: str
    path: str | None
    columns: list | None
    value: str | None


@dataclass
class Loaded:
    model: PipelineModel
    version: str
    columns: list


class Registry:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._append([])                                # an empty registry can be read

    # ------------------------------------------------------------------ table
    def _append(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{self.folder}/entries")

    def _add(self, model, imputation, version, kind, path=None, columns=None, value=None):
        if imputation not in IMPUTATIONS:
            raise ValueError(f"unknown imputation {imputation!r}")
        if version not in LADDER:
            raise ValueError(f"unknown version {version!r}")
        self._append([(model_name(model), imputation, version, kind, path, columns, value, self.entries().count())])

    def entries(self) -> DataFrame:
        """All candidates, one row each; a later row of the same key replaces an earlier one."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/entries")

    def resolve(self, model: str, imputation: str, kind: str, version: str | None = None) -> Candidate | None:
        """The first candidate of the ladder, or of the one version asked for; None if there is none.
        An unknown model, variant or version is an error."""
        if imputation not in IMPUTATIONS:
            raise ValueError(f"unknown imputation {imputation!r}")
        if version is not None and version not in LADDER:
            raise ValueError(f"unknown version {version!r}")
        tried = list(LADDER) if version is None else [version]
        rung = F.array_position(F.array(*map(F.lit, tried)), F.col("version"))
        r = self.entries().filter((F.col("model") == model_name(model)) & (F.col("imputation") == imputation)
                                  & (F.col("kind") == kind) & F.col("version").isin(tried)) \
            .orderBy(rung, F.col("added").desc()).first()
        return None if r is None else Candidate(r["model"], r["imputation"], r["version"], r["path"], r["columns"], r["value"])

    # ------------------------------------------------------------------ kinds
    def put_pipeline(self, model: str, imputation: str, version: str, fitted: PipelineModel, columns: list[str]) -> str:
        path = f"{self.folder}/pipelines/{model_name(model)}-{uuid.uuid4().hex[:8]}"
        fitted.write().save(path)
        self._add(model, imputation, version, "pipeline", path, list(columns))
        return path

    def pipeline(self, model: str, imputation: str, version: str | None = None) -> Loaded | None:
        """The fitted pipeline with its training columns (L-22); None where nothing is stored."""
        c = self.resolve(model, imputation, "pipeline", version)
        return None if c is None else Loaded(PipelineModel.load(c.path), c.version, list(c.columns))

    def put_params(self, model: str, imputation: str, version: str, params: dict):
        self._add(model, imputation, version, "params", value=json.dumps(params))

    def params(self, model: str, imputation: str, version: str | None = None) -> dict | None:
        """Tuned parameters with prefixes stripped and unsupported names dropped (L-7)."""
        c = self.resolve(model, imputation, "params", version)
        return None if c is None else L.clean_params(json.loads(c.value), L.supported_params(c.model))

    def put_threshold(self, model: str, imputation: str, version: str, threshold: float):
        self._add(model, imputation, version, "threshold", value=json.dumps(float(threshold)))

    def threshold(self, model: str, imputation: str, version: str | None = None, default: float = 0.5) -> float:
        """The saved threshold, else the default."""
        c = self.resolve(model, imputation, "threshold", version)
        return default if c is None else float(json.loads(c.value))
