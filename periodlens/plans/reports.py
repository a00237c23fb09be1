"""The report catalog (R1-R10, X1, X2) built from the two facts.

Each report is a function ``(population, ridership, by_year=False) -> DataFrame``
over the fact DataFrames (read from Parquet, or built in the same plan) or over their
lattices (:mod:`periodlens.operators.lattice`), which fold each fact once for all reports. Over a fact, every
report scans a fact with pushed-down phase / semester filters, aggregates it in
one pass with conditional averages, and joins only small aggregates. With
``by_year=True`` (facts built with ``by_year=True``) ``exam_year`` becomes a key
and periods of different years are no longer pooled.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import lift
from ..functions.stable import STABLE
from ..operators.lattice import Source, mean, sum_and_count
from ..operators.metrics import did, phase_avg, ranked, with_lifts, with_zscores
from ..sources.dimensions import NORMAL

AREA = ["area_id", "area_name", "area_type"]


def _period_keys(by_year: bool) -> list[str]:
    return ["semester", "exam_type"] + (["exam_year"] if by_year else [])


def population_phase_change(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Average night population before / during / after, with two lifts."""
    keys = _period_keys(by_year) + AREA
    avgs = phase_avg(
        population,
        keys,
        [
            ("before_population", "total_population", "before"),
            ("during_population", "total_population", "during"),
            ("after_population", "total_population", "after"),
        ], scales=scales)
    return with_lifts(
        avgs,
        [("during_lift", "before_population", "during_population"), ("after_lift", "before_population", "after_population")],
    )


def young_population_lift(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """R2: young population before vs after, lift, rank within the period."""
    pk = _period_keys(by_year)
    avgs = phase_avg(
        population,
        pk + AREA,
        [
            ("before_young_population", "young_20s_population", "before"),
            ("after_young_population", "young_20s_population", "after"),
        ], scales=scales)
    lifted = with_lifts(avgs, [("young_after_lift", "before_young_population", "after_young_population")])
    return ranked(lifted, pk, "young_after_lift")


def subway_alighting_lift(population: Source | None, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Night exits before vs after, lift, rank within the period."""
    pk = _period_keys(by_year)
    avgs = phase_avg(
        ridership,
        pk + AREA,
        [("before_alighting", "alighting_count", "before"), ("after_alighting", "alighting_count", "after")], scales=scales)
    lifted = with_lifts(avgs, [("alighting_after_lift", "before_alighting", "after_alighting")])
    return ranked(lifted, pk, "alighting_after_lift")


def hotplace_rank_compare(population: Source, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Rank areas by after-exam population and by after-exam exits; rank gap."""
    pk = _period_keys(by_year)
    pop = phase_avg(population, pk + AREA, [("after_population", "total_population", "after")], scales=scales)
    sub = phase_avg(ridership, pk + ["area_id"], [("after_alighting", "alighting_count", "after")], scales=scales)
    joined = pop.join(sub, pk + ["area_id"], "inner")
    both = ranked(ranked(joined, pk, "after_population", "population_rank"), pk, "after_alighting", "subway_rank")
    return both.select(
        *pk, *AREA, "after_population", "after_alighting", "population_rank", "subway_rank",
        (F.col("population_rank") - F.col("subway_rank")).alias("rank_gap"),
    )


def area_type_change(population: Source, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Before / after / lift of three measures per area type."""
    keys = _period_keys(by_year) + ["area_type"]
    pop = phase_avg(
        population,
        keys,
        [
            ("before_population", "total_population", "before"),
            ("after_population", "total_population", "after"),
            ("before_young_population", "young_20s_population", "before"),
            ("after_young_population", "young_20s_population", "after"),
        ], scales=scales)
    sub = phase_avg(
        ridership,
        keys,
        [("before_alighting", "alighting_count", "before"), ("after_alighting", "alighting_count", "after")], scales=scales)
    merged = pop.join(sub, keys, "inner")
    return merged.select(
        *keys,
        "before_population", "after_population",
        lift("before_population", "after_population").alias("population_after_lift"),
        "before_young_population", "after_young_population",
        lift("before_young_population", "after_young_population").alias("young_after_lift"),
        "before_alighting", "after_alighting",
        lift("before_alighting", "after_alighting").alias("alighting_after_lift"),
    )


def time_band_young_lift(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Young population lift per area and time band, ranked within (period, band)."""
    pk = _period_keys(by_year)
    avgs = phase_avg(
        population,
        pk + AREA + ["time_band"],
        [
            ("before_young_population", "young_20s_population", "before"),
            ("after_young_population", "young_20s_population", "after"),
        ], scales=scales)
    lifted = with_lifts(avgs, [("young_after_lift", "before_young_population", "after_young_population")])
    return ranked(lifted, pk + ["time_band"], "young_after_lift")


def weekend_effect(population: Source, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Young population and exits, before / after / lift, weekday vs weekend."""
    pk = _period_keys(by_year)
    pop = phase_avg(
        population,
        pk + AREA + ["is_weekend"],
        [
            ("before_young_population", "young_20s_population", "before"),
            ("after_young_population", "young_20s_population", "after"),
        ], scales=scales)
    sub = phase_avg(
        ridership,
        pk + ["area_id", "is_weekend"],
        [("before_alighting", "alighting_count", "before"), ("after_alighting", "alighting_count", "after")], scales=scales)
    merged = pop.join(sub, pk + ["area_id", "is_weekend"], "inner")
    return merged.select(
        *pk, *AREA, "is_weekend",
        "before_young_population", "after_young_population",
        lift("before_young_population", "after_young_population").alias("young_after_lift"),
        "before_alighting", "after_alighting",
        lift("before_alighting", "after_alighting").alias("alighting_after_lift"),
    )


def after_vs_normal(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """After-exam averages against the area's baseline outside every period.

    One scan: sums and counts per (area, period, phase); the baseline is then a window
    over an area's few rows of sums."""
    pk = _period_keys(by_year)
    sc = scales or {}
    measures = {"young": "young_20s_population", "total": "total_population"}
    phase, after = F.col("phase"), (F.col("phase") == "after") & F.col("semester").isNotNull()
    rows = population.filter((phase == NORMAL) | after)

    def parts(short: str, x: str) -> list:
        total, n = sum_and_count(rows, x, sc.get(x))
        return [total.alias(f"_{short}_sum"), n.alias(f"_{short}_n")]

    sums = rows.groupBy(*AREA, *pk, "phase").agg(*[c for short, x in measures.items() for c in parts(short, x)])
    area = Window.partitionBy("area_id")

    def average(short: str, baseline: bool) -> Column:
        total, n = F.col(f"_{short}_sum"), F.col(f"_{short}_n")
        if baseline:
            total, n = (F.sum(F.when(phase == NORMAL, c)).over(area) for c in (total, n))
        scale = sc.get(measures[short])
        ratio = F.when(n > 0, total / n)
        return ratio if scale in (None, STABLE) else ratio / float(10**scale)

    merged = sums.select(
        *AREA, *pk, "phase", F.max(phase == NORMAL).over(area).alias("_has_normal"),
        *[average(short, True).alias(f"normal_{short}_population") for short in measures],
        *[average(short, False).alias(f"after_{short}_population") for short in measures],
    ).filter((phase == "after") & F.col("_has_normal"))
    return merged.select(
        *AREA, *pk,
        "normal_young_population", "after_young_population",
        lift("normal_young_population", "after_young_population").alias("young_after_vs_normal_lift"),
        "normal_total_population", "after_total_population",
        lift("normal_total_population", "after_total_population").alias("total_after_vs_normal_lift"),
    )


def did_young_population(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Treatment (university areas) vs control (nightlife areas), young population."""
    scale = (scales or {}).get("young_20s_population")
    return did(population, "young_20s_population", "young", _period_keys(by_year), scale=scale)


def did_subway_alighting(population: Source | None, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Treatment vs control difference in differences of exits."""
    scale = (scales or {}).get("alighting_count")
    return did(ridership, "alighting_count", "alighting", _period_keys(by_year), scale=scale)


def hotplace_score(population: Source, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """z(after population) + z(young lift) + z(exit lift) within each period."""
    pk = _period_keys(by_year)
    pop = phase_avg(
        population,
        pk + AREA,
        [
            ("after_population", "total_population", "after"),
            ("before_young_population", "young_20s_population", "before"),
            ("after_young_population", "young_20s_population", "after"),
        ], scales=scales)
    sub = phase_avg(
        ridership,
        pk + ["area_id"],
        [("before_alighting", "alighting_count", "before"), ("after_alighting", "alighting_count", "after")], scales=scales)
    joined = pop.join(sub, pk + ["area_id"], "inner").select(
        *pk, *AREA, "after_population",
        lift("before_young_population", "after_young_population").alias("young_after_lift"),
        lift("before_alighting", "after_alighting").alias("alighting_after_lift"),
    )
    scored = with_zscores(
        joined,
        {"z_population": "after_population", "z_young_lift": "young_after_lift", "z_alighting_lift": "alighting_after_lift"},
        pk,
    ).withColumn("hotplace_score", F.col("z_population") + F.col("z_young_lift") + F.col("z_alighting_lift"))
    return ranked(scored, pk, "hotplace_score", "hotplace_rank")


def midterm_vs_final(population: Source, ridership: Source | None = None, by_year: bool = False, scales: dict[str, int] | None = None) -> DataFrame:
    """Young population lift after the midterm vs after the final, per area."""
    keys = ["semester"] + (["exam_year"] if by_year else []) + AREA
    rows = population.filter(
        F.col("phase").isin("before", "after")
        & F.col("semester").isNotNull()
        & F.col("exam_type").isin("midterm", "final")
    )

    scale = (scales or {}).get("young_20s_population")

    def cavg(exam: str, phase: str):
        cond = (F.col("exam_type") == exam) & (F.col("phase") == phase)
        return mean(rows, "young_20s_population", cond, scale).alias(f"{exam}_{phase}_young")

    avgs = rows.groupBy(*keys).agg(
        cavg("midterm", "before"), cavg("midterm", "after"), cavg("final", "before"), cavg("final", "after")
    )
    out = avgs.select(
        *keys,
        "midterm_before_young", "midterm_after_young",
        lift("midterm_before_young", "midterm_after_young").alias("midterm_young_lift"),
        "final_before_young", "final_after_young",
        lift("final_before_young", "final_after_young").alias("final_young_lift"),
    )
    return out.withColumn("final_minus_midterm_lift", F.col("final_young_lift") - F.col("midterm_young_lift"))


@dataclass(frozen=True)
class Report:
    name: str
    build: Callable[..., DataFrame]
    export_columns: list[str]
    export_order: list[str]  # column names, '-name' for descending


def _desc(c: str) -> str:
    """Export order entries are column names; a leading '-' means descending."""
    return "-" + c


def order_columns(order: list[str]) -> list:
    """Column objects for an export order (resolved lazily, inside a session)."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


REPORTS: dict[str, Report] = {
    r.name: r
    for r in [
        Report(
            "population_phase_change", population_phase_change,
            ["semester", "exam_type", *AREA, "before_population", "during_population", "after_population", "during_lift", "after_lift"],
            ["semester", "exam_type", _desc("after_lift")],
        ),
        Report(
            "young_population_lift", young_population_lift,
            ["semester", "exam_type", "rank_no", *AREA, "before_young_population", "after_young_population", "young_after_lift"],
            ["semester", "exam_type", "rank_no"],
        ),
        Report(
            "subway_alighting_lift", subway_alighting_lift,
            ["semester", "exam_type", "rank_no", *AREA, "before_alighting", "after_alighting", "alighting_after_lift"],
            ["semester", "exam_type", "rank_no"],
        ),
        Report(
            "hotplace_rank_compare", hotplace_rank_compare,
            ["semester", "exam_type", *AREA, "after_population", "after_alighting", "population_rank", "subway_rank", "rank_gap"],
            ["semester", "exam_type", "population_rank"],
        ),
        Report(
            "area_type_change", area_type_change,
            ["semester", "exam_type", "area_type", "before_population", "after_population", "population_after_lift",
             "before_young_population", "after_young_population", "young_after_lift",
             "before_alighting", "after_alighting", "alighting_after_lift"],
            ["semester", "exam_type", "area_type"],
        ),
        Report(
            "time_band_young_lift", time_band_young_lift,
            ["semester", "exam_type", "time_band", "rank_no", *AREA, "before_young_population", "after_young_population", "young_after_lift"],
            ["semester", "exam_type", "time_band", "rank_no"],
        ),
        Report(
            "weekend_effect", weekend_effect,
            ["semester", "exam_type", "is_weekend", *AREA, "before_young_population", "after_young_population", "young_after_lift",
             "before_alighting", "after_alighting", "alighting_after_lift"],
            ["semester", "exam_type", "is_weekend", _desc("young_after_lift")],
        ),
        Report(
            "after_vs_normal", after_vs_normal,
            ["semester", "exam_type", *AREA, "normal_young_population", "after_young_population", "young_after_vs_normal_lift",
             "normal_total_population", "after_total_population", "total_after_vs_normal_lift"],
            ["semester", "exam_type", _desc("young_after_vs_normal_lift")],
        ),
        Report(
            "did_young_population", did_young_population,
            ["semester", "exam_type", "treatment_before_young", "treatment_after_young", "treatment_lift",
             "control_before_young", "control_after_young", "control_lift", "did_lift"],
            ["semester", "exam_type"],
        ),
        Report(
            "did_subway_alighting", did_subway_alighting,
            ["semester", "exam_type", "treatment_before_alighting", "treatment_after_alighting", "treatment_lift",
             "control_before_alighting", "control_after_alighting", "control_lift", "did_lift"],
            ["semester", "exam_type"],
        ),
        Report(
            "hotplace_score", hotplace_score,
            ["semester", "exam_type", "hotplace_rank", *AREA, "after_population", "young_after_lift", "alighting_after_lift",
             "z_population", "z_young_lift", "z_alighting_lift", "hotplace_score"],
            ["semester", "exam_type", "hotplace_rank"],
        ),
        Report(
            "midterm_vs_final", midterm_vs_final,
            ["semester", *AREA, "midterm_before_young", "midterm_after_young", "midterm_young_lift",
             "final_before_young", "final_after_young", "final_young_lift", "final_minus_midterm_lift"],
            ["semester", "area_id"],
        ),
    ]
}


def run_report(
    name: str, population: Source, ridership: Source, by_year: bool = False, scales: dict[str, int] | None = None
) -> DataFrame:
    """Build one report. ``scales`` maps measures recorded with a fixed number of
    decimals to that number, so their averages are computed exactly."""
    return REPORTS[name].build(population, ridership, by_year=by_year, scales=scales)
