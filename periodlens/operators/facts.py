"""Fact roll-up: observations -> one row per (date, hour, area, period label).

Plan shape:

    scan -> filter(parsed, night hours) -> SUM per (date, hour, unit), partial first
         -> join units->areas -> join calendar days -> SUM per roll-up key
         -> date parts, band, ratio

Sums are decomposable, so the feed is summed per (date, hour, unit) before it meets
the unit map: whatever join the planner picks carries partial sums, and a unit that
holds a third of all observations is one row per (date, hour) there.

The aggregation groups only by the independent keys; date parts and the time
band are functions of ``date`` and ``hour`` and are computed after the roll-up,
on the (small) aggregated rows instead of on every input row. The output grain
is bounded by days x 9 hours x areas x labels, and a hot area is absorbed by the
map-side partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    date_parts,
    from_units,
    guarded_ratio,
    in_night_window,
    time_band,
    to_units,
)
from ..functions.stable import STABLE, stable_sum
from .joins import join_dimension
from .periods import label_periods, previous_day_for_late_night

# Column order of the facts (the first 14 are shared by both facts).
FACT_KEYS = [
    "date", "year", "month", "day_of_week", "day_of_week_num", "is_weekend", "hour", "time_band",
    "area_id", "area_name", "area_type", "phase", "exam_type", "semester",
]
AREA_COLUMNS = ["area_id", "area_name", "area_type"]


@dataclass(frozen=True)
class Measure:
    """A summed fact measure.

    ``scale``: when set, the input is summed exactly as a bigint count of
    10**-scale units (inputs recorded with that many decimals), which makes the
    distributed sum independent of row order. ``STABLE`` does that for any doubles, by
    binned sums. ``dtype`` is the output type.
    """

    name: str
    scale: int | str | None = None
    dtype: str = "double"

    def partial(self) -> Column:
        """The sum per unit: in exact units when there is a scale."""
        if self.scale == STABLE:
            return stable_sum(self.name).alias(self.name)
        value = F.col(self.name) if self.scale is None else to_units(F.col(self.name), self.scale)
        return F.sum(value).alias(self.name)

    def total(self) -> Column:
        """The sum of partial sums, in the output type."""
        if self.scale == STABLE:
            return stable_sum(self.name).cast(self.dtype).alias(self.name)
        sums = F.sum(F.col(self.name))
        return (sums if self.scale is None else from_units(sums, self.scale)).cast(self.dtype).alias(self.name)


def rollup_fact(
    observations: DataFrame,
    units: DataFrame,
    calendar: DataFrame,
    measures: list[Measure],
    unit_col: str = "unit_code",
    *,
    by_year: bool = False,
    late_night: str = "same_day",
    strategy: str = "expanded",
    literal_units: bool = False,
    gates=None,
    derived: dict[str, Column] | None = None,
) -> DataFrame:
    """Roll observations ``(date, hour, <unit_col>, measures...)`` up to the fact grain.

    * rows with NULL date or hour, or an hour outside the night window, are dropped;
    * ``units`` maps ``unit_col`` to ``area_id, area_name, area_type`` (inner join;
      a unit under two areas counts in both);
    * ``late_night='previous_day'`` files hours 0-2 under the evening before;
    * ``by_year`` keeps ``exam_year`` as a key, so periods of different years with
      the same semester and exam type are not pooled;
    * ``gates`` (a :class:`periodlens.operators.quality.Gates`) counts the observations
      left after the night filter, with a known unit, and with an area, in the same job;
    * ``literal_units`` states that ``units`` is a table of literal rows;
    * a unit that is known but has no area (NULL ``area_id``) is dropped after its gate;
    * ``derived`` adds columns computed from the summed measures (after them).
    """
    if late_night not in ("same_day", "previous_day"):
        raise ValueError("late_night must be 'same_day' or 'previous_day'")
    obs = observations.select(
        F.col("date"), F.col("hour").cast("int").alias("hour"), F.col(unit_col), *[F.col(m.name) for m in measures]
    ).filter(F.col("date").isNotNull() & F.col("hour").isNotNull() & in_night_window("hour"))
    if late_night == "previous_day":
        obs = obs.withColumn("date", previous_day_for_late_night(F.col("date"), F.col("hour")))
    counted = [F.count(F.lit(1)).alias("_rows")] if gates is not None else []
    summed = obs.groupBy("date", "hour", unit_col).agg(*[m.partial() for m in measures], *counted)
    if gates is not None:
        summed = gates.watch(summed, "night hours", "_rows")

    located = join_dimension(summed, units.select(unit_col, *AREA_COLUMNS), unit_col, literal=literal_units)
    if gates is not None:
        located = gates.watch(located, "unit lookup", "_rows")
    located = located.filter(F.col("area_id").isNotNull())
    if gates is not None:
        located = gates.watch(located, "area lookup", "_rows").drop("_rows")
    labelled = label_periods(located.drop(unit_col), calendar, "date", strategy)

    keys = ["date", "hour", *AREA_COLUMNS, "phase", "exam_type", "semester"] + (["exam_year"] if by_year else [])
    rolled = labelled.groupBy(*keys).agg(*[m.total() for m in measures])

    parts = date_parts("date")
    out = [
        F.col("date"),
        *[parts[k].alias(k) for k in ("year", "month", "day_of_week", "day_of_week_num", "is_weekend")],
        F.col("hour"),
        time_band("hour").alias("time_band"),
        *[F.col(k) for k in FACT_KEYS[8:]],
    ]
    if by_year:
        out.append(F.col("exam_year"))
    sums = [F.col(m.name) for m in measures]
    return rolled.select(*out, *sums, *[c.alias(n) for n, c in (derived or {}).items()])


def population_fact(
    observations: DataFrame,
    units: DataFrame,
    calendar: DataFrame,
    unit_col: str = "unit_code",
    scale: int | None = None,
    **options,
) -> DataFrame:
    """Population fact (A1): SUM total and young population, plus the guarded ratio.

    ``observations`` has ``date, hour, <unit_col>, total_population,
    young_20s_population``.
    """
    measures = [Measure("total_population", scale), Measure("young_20s_population", scale)]
    ratio = {"young_20s_ratio": guarded_ratio("young_20s_population", "total_population").cast("double")}
    return rollup_fact(observations, units, calendar, measures, unit_col, derived=ratio, **options)


def ridership_fact(
    observations: DataFrame,
    units: DataFrame,
    calendar: DataFrame,
    unit_col: str = "unit_code",
    **options,
) -> DataFrame:
    """Ridership fact (A2): SUM of exits per (date, hour, area, label) as bigint.

    ``observations`` has ``date, hour, <unit_col>, alighting_count``.
    """
    measures = [Measure("alighting_count", None, "bigint")]
    return rollup_fact(observations, units, calendar, measures, unit_col, **options)
