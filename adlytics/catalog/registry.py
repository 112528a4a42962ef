"""Registry of the queries the driver runs: name -> (spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(expr: str) -> str:
    """SQL twin of the Spark-side rounding: 6 decimals, -0.0 folded to 0.0."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def load_all():
    """Import every catalog module so its queries register."""
    from adlytics.catalog import (q_clean, q_corr, q_metrics, q_missing, q_profile,  # noqa: F401
                                  q_relational, q_sampling, q_transform, q_train, q_score)
    return QUERIES, ORACLES
