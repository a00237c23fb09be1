"""One aggregate per fact that all reports fold.

Every report averages a measure over some of a fact's rows, grouped by some of (area, period, phase, time
band, weekend). A :class:`Lattice` holds sums and counts of the measures at the finest of these keys: one scan of the fact,
whose size then no report depends on. Reports take a lattice wherever they take a fact; sums of sums over sums of
counts are the same averages (bit for bit where a measure has a scale: its sums are whole numbers).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.columns import to_units
from ..functions.stable import STABLE, stable_sum

KEYS = ["area_id", "area_name", "area_type", "semester", "exam_type", "phase", "time_band", "is_weekend"]
MEASURES = {"area_population": ["total_population", "young_20s_population"], "area_subway": ["alighting_count"]}


@dataclass(frozen=True)
class Lattice:
    """Sums (``<measure>_sum``, in whole units where the measure has a scale) and counts (``<measure>_n``) by KEYS."""

    frame: DataFrame
    scales: dict[str, int] = field(default_factory=dict)

    def filter(self, condition: Column) -> Lattice:
        return replace(self, frame=self.frame.filter(condition))

    def groupBy(self, *keys: str) -> GroupedData:
        return self.frame.groupBy(*keys)


Source = DataFrame | Lattice


def lattice(fact: DataFrame, measures: Sequence[str], by_year: bool = False, scales: dict[str, int] | None = None) -> Lattice:
    """Fold a fact to its lattice; ``scales`` as in the reports."""
    scales = {m: s for m, s in (scales or {}).items() if m in measures}
    keys = KEYS + (["exam_year"] if by_year else [])
    parts = [c.alias(n) for m in measures for c, n in zip(sum_and_count(fact, m, scales.get(m)), (f"{m}_sum", f"{m}_n"))]
    return Lattice(fact.groupBy(*keys).agg(*parts), scales)


def sum_and_count(source: Source, measure: str, scale: int | None = None, condition: Column | None = None) -> tuple[Column, Column]:
    """Aggregates over a fact's or a lattice's rows: the sum (in whole units with a ``scale``) and the number of values."""
    if isinstance(source, Lattice):
        if source.scales.get(measure) != scale:
            raise ValueError(f"the lattice was made with scale {source.scales.get(measure)} of {measure}, not {scale}")
        total, n = F.col(f"{measure}_sum"), F.col(f"{measure}_n")
        if condition is not None:
            total, n = F.when(condition, total), F.when(condition, n)
        return (stable_sum(total) if scale == STABLE else F.sum(total)), F.coalesce(F.sum(n), F.lit(0))
    value = F.col(measure) if condition is None else F.when(condition, F.col(measure))
    if scale == STABLE:
        return stable_sum(value), F.count(value)
    return F.sum(value if scale is None else to_units(value, scale)), F.count(value)


def mean(source: Source, measure: str, condition: Column | None = None, scale: int | None = None) -> Column:
    """AVG of a measure over the rows where ``condition`` holds (A3); exact with a ``scale``, independent of the rows'
    order with ``scale=STABLE``."""
    if scale is None and not isinstance(source, Lattice):
        return F.avg(measure if condition is None else F.when(condition, F.col(measure)))
    total, n = sum_and_count(source, measure, scale, condition)
    ratio = F.when(n > 0, total / n)
    return ratio if scale in (None, STABLE) else ratio / float(10**scale)
