"""Data-quality gates (Q1, O2).

A gate "this stage produced rows" costs one extra job per gate when written as
``take(1)``. Here every gate is an ``Observation`` attached to the
plan: the row counts of all stages are collected by the one job that writes the
result, and :meth:`Gates.check` raises naming the first empty stage.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class EmptyStageError(ValueError):
    pass


class Gates:
    def __init__(self, prefix: str = "gate"):
        self._prefix = prefix
        self._stages: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, label: str, rows: str | None = None) -> DataFrame:
        """Count the rows flowing out of ``df`` under ``label`` (for pre-aggregated
        rows: the sum of their row counts in column ``rows``)."""
        obs = Observation(f"{self._prefix}:{label}:{len(self._stages)}")
        self._stages.append((label, obs))
        counted = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
        return df.observe(obs, counted.alias("rows"))

    def counts(self) -> dict[str, int]:
        """Row count per watched stage (available after an action ran the plan).

        A stage below an empty one may be pruned from the executed plan (AQE
        propagates empty relations); its observation then reports no metrics: no row
        reached it, and it counts as 0."""
        out = {}
        for label, obs in self._stages:
            try:
                out[label] = int(obs.get.get("rows", 0))
            except Py4JJavaError as e:
                # what Spark raises for an observation without metrics, and nothing else
                if e.java_exception.getClass().getName() != "java.lang.AssertionError":
                    raise
                out[label] = 0
        return out

    def check(self) -> dict[str, int]:
        counts = self.counts()
        for label, n in counts.items():
            if n == 0:
                raise EmptyStageError(f"no rows left after {label}")
        return counts


def existence(df: DataFrame, label: str) -> DataFrame:
    """Existence probe (O2) as one row (label, present): at most one row per task is looked at."""
    return df.select(F.lit(1).alias("one")).limit(1).agg(F.lit(label).alias("label"), (F.count("one") > 0).alias("present"))


def is_nonempty(df: DataFrame) -> bool:
    """Existence probe (O2): stops at the first row."""
    return existence(df, "").first()["present"]
