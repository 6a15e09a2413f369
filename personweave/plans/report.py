"""What a run did: counters that Spark gathers while the job writes its tables, its start and end, and whether it failed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SUMMARY = ("status string, health string, input_entities long, canonicals long, merge_rate double, started timestamp, ended timestamp, "
           "seconds double, error string")
COUNTERS = "total long, new_entities long, matched long, errors long, seconds double"


class Watch:
    """Counts rows of the tables it is shown as they are written; no table is read for it.

    Show it a table that one action reads once: a table that is not written, or only partly, has no counters.
    """

    def __init__(self) -> None:
        self.started = datetime.now(timezone.utc)
        self._seen: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame, **counts: Column) -> DataFrame:
        """`df`, whose rows are counted under `name`, as well as the `counts` (aggregates) given."""
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])

    def of(self, name: str) -> dict[str, Any]:
        """The counters of a table whose writing has ended."""
        return self._seen[name].get


@dataclass(frozen=True)
class Run:
    result: Any  # what the job returned; None if it failed
    summary: DataFrame


def nulls(*columns: str) -> Column:
    """How many rows lack one of the columns."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return F.count(F.when(missing, 1))


def reported(spark: SparkSession, job: Callable[[Watch], Any]) -> Run:
    """Run `job` with a watch that it passes on to `reconcile`, and sum it up in one row.

    `health` follows from rows of the crosswalk without an id. A job that raises is reported as `failed` with the error and
    without counters; its tables are as the job left them.
    """
    watch = Watch()
    try:
        result, error = job(watch), None
    except Exception as e:  # whatever stopped the job is what the summary reports
        result, error = None, f"{type(e).__name__}: {e}"
    ended = datetime.now(timezone.utc)
    seconds = (ended - watch.started).total_seconds()
    if error is not None:
        row = ("failed", None, None, None, None, watch.started, ended, seconds, error)
    else:
        inputs, canonicals = watch.of("input")["rows"], watch.of("golden")["rows"]
        health = "healthy" if watch.of("crosswalk")["broken"] == 0 else "check data"
        rate = round(1 - canonicals / inputs, 6) if inputs else None
        row = ("completed", health, inputs, canonicals, rate, watch.started, ended, seconds, None)
    return Run(result, spark.createDataFrame([row], SUMMARY))


def batch_counters(spark: SparkSession, watch: Watch) -> DataFrame:
    """Counters of a batch of changes that was stored with `watch`: total, new, matched, errors, and seconds."""
    results, errors = watch.of("results"), watch.of("errors")["rows"]
    row = (results["rows"] + errors, results["new"], results["rows"] - results["new"], errors,
           (datetime.now(timezone.utc) - watch.started).total_seconds())
    return spark.createDataFrame([row], COUNTERS)
