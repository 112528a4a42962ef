"""Named jobs on a bounded pool, each run to its end, with a status row each (S15, B2, M5, L-6, L-11).

A job is a function that does its own work (fits a model, writes rows). It runs in a thread with a
Spark job group of its name; whatever it raises while running is kept in its outcome, so one
failing job neither stops nor hides the others. Nothing is retried or replaced here: callers read
the status and decide.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from adlytics.session import cut_lineage

STATUS = "job string, status string, error string, seconds double"


@dataclass
class Outcome:
    name: str
    value: Any = None
    error: BaseException | None = None
    seconds: float = 0.0

    @property
    def ok(self) -> bool:
        return self.error is None

    @property
    def message(self) -> str | None:
        return None if self.ok else f"{type(self.error).__name__}: {self.error}".split("\n")[0][:300]


class JobsFailed(RuntimeError):
    """Some jobs failed; ``outcomes`` has all of them."""

    def __init__(self, outcomes: dict[str, Outcome]):
        self.outcomes = outcomes
        super().__init__("; ".join(f"{o.name}: {o.message}" for o in outcomes.values() if not o.ok))


def run_jobs(spark: SparkSession, jobs: dict[str, Callable[[], Any]], parallelism: int = 4) -> dict[str, Outcome]:
    """Outcomes by name, in the order of ``jobs``; at most ``parallelism`` run at a time."""
    def run(item):
        name, job = item
        out, t0 = Outcome(name), time.time()
        spark.sparkContext.setJobGroup(name, name)
        try:
            out.value = job()
        except Exception as e:  # kept as the job's outcome
            out.error = e
        out.seconds = time.time() - t0
        return out

    if not jobs:
        return {}
    pool = ThreadPool(processes=max(1, min(parallelism, len(jobs))))
    try:
        done = pool.map(inheritable_thread_target(spark)(run), list(jobs.items()), chunksize=1)
    finally:
        pool.close()
        pool.join()
    return {o.name: o for o in done}


def values(outcomes: dict[str, Outcome]) -> dict[str, Any]:
    """The values of all jobs; raises if any failed."""
    if any(not o.ok for o in outcomes.values()):
        raise JobsFailed(outcomes)
    return {k: o.value for k, o in outcomes.items()}


def require_all(status: DataFrame) -> None:
    """Raises ``JobsFailed`` if a job of a status table failed: for callers whose result has no place for
    a missing part."""
    failed = status.filter("status <> 'ok'").collect()                     # one row per job
    if failed:
        raise JobsFailed({r["job"]: Outcome(r["job"], error=RuntimeError(r["error"]), seconds=r["seconds"]) for r in failed})


def status_table(spark: SparkSession, outcomes: dict[str, Outcome]) -> DataFrame:
    """(job, status, error, seconds), one row per job."""
    return spark.createDataFrame([(o.name, "ok" if o.ok else "failed", o.message, o.seconds) for o in outcomes.values()], STATUS)


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed now, as a reliable checkpoint: a failure of its tasks shows here."""
    return cut_lineage(df)
