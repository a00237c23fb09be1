"""Query catalog over the driver's test tables, with independent oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library's operators on the
whole test tables (stand-in mapping in :mod:`periodlens.sources.testdata`).
``ORACLE_SQL[name]`` is a separately written ANSI/DuckDB text computing the same
rows from the same tables; the two share no code.

Doubles are rounded to 6 decimals in both so that summation order (which
differs between engines) cannot change the compared values.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stable import STABLE
from ..operators.facts import population_fact, ridership_fact
from ..operators.lattice import MEASURES, Lattice, lattice
from ..sources import testdata as td
from .reports import REPORTS

QueryFn = Callable[[SparkSession, str], DataFrame]
ROUND_DIGITS = 6
# plain double sums depend on the order of the rows in their last digits: fewer digits are
# compared, and a shift keeps half-way values from rounding either way
PLAIN_DIGITS, PLAIN_SHIFT = 3, 1e-7


def round_like_sql(c, digits: int = ROUND_DIGITS):
    """round(x * 10^d) / 10^d, half away from zero on the scaled double: the rule the
    oracle engine applies, so exact half-way values round the same in both."""
    scale = float(10**digits)
    return F.round(c * scale) / scale


def rounded(df: DataFrame, digits: int = ROUND_DIGITS, shift: float = 0.0) -> DataFrame:
    """Round every double column (for engine-independent comparison), after adding ``shift``."""
    return df.select(
        *[
            round_like_sql(F.col(f.name) + shift if shift else F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def event_population_fact(spark: SparkSession, sf_dir: str, units: DataFrame | None = None, **options) -> DataFrame:
    units = units if units is not None else td.unit_areas(spark, sf_dir)
    options.setdefault("scale", td.VALUE_SCALE)
    return population_fact(td.event_observations(spark, sf_dir), units, td.event_calendar(spark), **options)


def event_ridership_fact(spark: SparkSession, sf_dir: str, units: DataFrame | None = None, **options) -> DataFrame:
    units = units if units is not None else td.unit_areas(spark, sf_dir)
    return ridership_fact(td.exit_observations(spark, sf_dir), units, td.event_calendar(spark), **options)


def event_facts(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """Both facts over one shared unit map."""
    units = td.unit_areas(spark, sf_dir)
    return event_population_fact(spark, sf_dir, units, **options), event_ridership_fact(spark, sf_dir, units, **options)


def _report_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pop, rid = event_facts(spark, sf_dir)
        return rounded(REPORTS[name].build(pop, rid, scales=td.MEASURE_SCALES))

    run.__name__ = f"report_{name}"
    return run


QUERIES: dict[str, QueryFn] = {
    "fact_population": lambda spark, sf: rounded(event_facts(spark, sf)[0]),
    "fact_ridership": lambda spark, sf: event_facts(spark, sf)[1],
    **{f"report_{name}": _report_query(name) for name in REPORTS},
}



def event_lattices(spark: SparkSession, sf_dir: str) -> tuple[Lattice, Lattice]:
    pop, rid = event_facts(spark, sf_dir)
    return lattice(pop, MEASURES["area_population"], scales=td.MEASURE_SCALES), lattice(rid, MEASURES["area_subway"], scales=td.MEASURE_SCALES)


def _lattice_report(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(REPORTS[name].build(*event_lattices(spark, sf_dir), scales=td.MEASURE_SCALES))

    return run


def lattice_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population lattice itself: whole units and counts at the finest report key."""
    return event_lattices(spark, sf_dir)[0].frame


#: the same reports, folded from the facts' lattices
LATTICE_QUERIES: dict[str, QueryFn] = {
    "lattice_population": lattice_population,
    **{f"lattice_{name}": _lattice_report(name) for name in ("weekend_effect", "after_vs_normal", "hotplace_score", "midterm_vs_final")},
}

#: as the jobs run by default: plain double sums and averages
PLAIN_QUERIES: dict[str, QueryFn] = {
    "fact_population_plain": lambda spark, sf: rounded(event_population_fact(spark, sf, scale=None), PLAIN_DIGITS, PLAIN_SHIFT),
    "report_area_type_change_plain": lambda spark, sf: rounded(
        REPORTS["area_type_change"].build(event_population_fact(spark, sf, scale=None), event_ridership_fact(spark, sf)), PLAIN_DIGITS, PLAIN_SHIFT
    ),
}


#: doubles without a stated scale, summed order-independently
STABLE_QUERIES: dict[str, QueryFn] = {
    "fact_population_stable": lambda spark, sf: rounded(event_population_fact(spark, sf, scale=STABLE)),
    "report_area_type_change_stable": lambda spark, sf: rounded(
        REPORTS["area_type_change"].build(
            event_population_fact(spark, sf, scale=STABLE), event_ridership_fact(spark, sf), scales=dict.fromkeys(td.MEASURE_SCALES, STABLE)
        ),
        PLAIN_DIGITS, PLAIN_SHIFT,
    ),
}


def all_queries() -> dict[str, QueryFn]:
    """Reports and fact builds plus the operator-level entries."""
    from . import catalog_ops

    return {**QUERIES, **PLAIN_QUERIES, **LATTICE_QUERIES, **STABLE_QUERIES, **catalog_ops.QUERIES}


def all_oracle_sql() -> dict[str, str]:
    from . import catalog_ops

    return {**ORACLE_SQL, **catalog_ops.ORACLE_SQL}


# ---------------------------------------------------------------------------
# Oracle side (DuckDB SQL, written independently of the Spark code)
# ---------------------------------------------------------------------------

_SQL_CALENDAR = """
cal(exam_year, semester, exam_type, phase, start_date, end_date) AS (VALUES
  (2024, 1, 'midterm', 'before', DATE '2024-01-03', DATE '2024-01-07'),
  (2024, 1, 'midterm', 'during', DATE '2024-01-08', DATE '2024-01-12'),
  (2024, 1, 'midterm', 'after',  DATE '2024-01-13', DATE '2024-01-17'),
  (2024, 1, 'final',   'before', DATE '2024-01-18', DATE '2024-01-21'),
  (2024, 1, 'final',   'during', DATE '2024-01-22', DATE '2024-01-24'),
  (2024, 1, 'final',   'after',  DATE '2024-01-25', DATE '2024-01-28'))"""

_SQL_UNITS = """
atype(r_name, area_type) AS (VALUES
  ('AFRICA', 'university'), ('AMERICA', 'culture_university'), ('ASIA', 'university_nightlife'),
  ('EUROPE', 'nightlife'), ('MIDDLE EAST', 'nightlife_business')),
units AS (
  SELECT c.c_custkey AS unit_code, CAST(n.n_nationkey AS VARCHAR) AS area_id, n.n_name AS area_name,
         t.area_type
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN atype t ON r.r_name = t.r_name)"""

_SQL_DATE_PARTS = """
  CAST(year(o.d) AS INTEGER) AS year, CAST(month(o.d) AS INTEGER) AS month,
  strftime(o.d, '%a') AS day_of_week, CAST(dayofweek(o.d) + 1 AS INTEGER) AS day_of_week_num,
  dayofweek(o.d) IN (0, 6) AS is_weekend, o.h AS hour,
  CASE WHEN o.h >= 18 AND o.h < 21 THEN 'evening' WHEN o.h >= 21 AND o.h < 24 THEN 'night'
       WHEN o.h >= 0 AND o.h <= 2 THEN 'late_night' ELSE 'other' END AS time_band"""

def sql_population(date_expr: str = "CAST(ts AS DATE)", name: str = "pop") -> str:
    """Population fact CTEs over ``events`` (``date_expr`` may shift late-night hours)."""
    return f"""
{name}_obs AS (
  SELECT {date_expr} AS d, CAST(hour(ts) AS INTEGER) AS h, user_id AS unit_code, value AS tot,
         CASE WHEN event_type IN ('view', 'click') THEN value ELSE 0 END AS yng
  FROM events),
{name}_raw AS (
  SELECT o.d AS date, {_SQL_DATE_PARTS},
    u.area_id, u.area_name, u.area_type,
    COALESCE(c.phase, 'normal') AS phase, COALESCE(c.exam_type, 'normal') AS exam_type, c.semester,
    CAST(SUM(CAST(ROUND(o.tot * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total_population,
    CAST(SUM(CAST(ROUND(o.yng * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS young_20s_population
  FROM {name}_obs o
  JOIN units u ON o.unit_code = u.unit_code
  LEFT JOIN cal c ON o.d >= c.start_date AND o.d <= c.end_date
  WHERE (o.h >= 18 AND o.h <= 23) OR (o.h >= 0 AND o.h <= 2)
  GROUP BY ALL),
{name} AS (
  SELECT *, CASE WHEN total_population > 0 THEN young_20s_population / total_population END AS young_20s_ratio
  FROM {name}_raw)"""


_SQL_POP = sql_population()

_SQL_RID = f"""
robs AS (
  SELECT CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h, user_id AS unit_code
  FROM events WHERE event_type = 'purchase'),
rid AS (
  SELECT o.d AS date, {_SQL_DATE_PARTS},
    u.area_id, u.area_name, u.area_type,
    COALESCE(c.phase, 'normal') AS phase, COALESCE(c.exam_type, 'normal') AS exam_type, c.semester,
    CAST(COUNT(*) AS BIGINT) AS alighting_count
  FROM robs o
  JOIN units u ON o.unit_code = u.unit_code
  LEFT JOIN cal c ON o.d >= c.start_date AND o.d <= c.end_date
  WHERE (o.h >= 18 AND o.h <= 23) OR (o.h >= 0 AND o.h <= 2)
  GROUP BY ALL)"""

_FACTS = f"WITH {_SQL_CALENDAR},{_SQL_UNITS},{_SQL_POP},{_SQL_RID}"
SQL_CALENDAR, SQL_UNITS, SQL_DATE_PARTS, SQL_FACTS = _SQL_CALENDAR, _SQL_UNITS, _SQL_DATE_PARTS, _FACTS


def _r(col: str, alias: str | None = None) -> str:
    return f"ROUND({col}, 6) AS {alias or col.split('.')[-1]}"


def _lift(base: str, new: str) -> str:
    return f"CASE WHEN {base} > 0 THEN ({new} - {base}) / {base} END"


def _xavg(col: str, cond: str | None = None) -> str:
    """Exact average of a cent-valued column: (sum of cents / count) / 100."""
    if cond is None:
        return f"CAST(SUM(CAST(ROUND({col} * 100) AS BIGINT)) AS DOUBLE) / COUNT({col}) / 100.0"
    return (
        f"CAST(SUM(CASE WHEN {cond} THEN CAST(ROUND({col} * 100) AS BIGINT) END) AS DOUBLE)"
        f" / COUNT(CASE WHEN {cond} THEN {col} END) / 100.0"
    )


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["fact_population"] = f"""{_FACTS}
SELECT date, year, month, day_of_week, day_of_week_num, is_weekend, hour, time_band, area_id, area_name,
       area_type, phase, exam_type, semester, {_r('total_population')}, {_r('young_20s_population')},
       {_r('young_20s_ratio')}
FROM pop"""

ORACLE_SQL["fact_ridership"] = f"""{_FACTS}
SELECT * FROM rid"""

ORACLE_SQL["report_population_phase_change"] = f"""{_FACTS},
s AS (
  SELECT semester, exam_type, area_id, area_name, area_type,
    {_xavg("total_population", "phase = 'before'")} AS b,
    {_xavg("total_population", "phase = 'during'")} AS du,
    {_xavg("total_population", "phase = 'after'")} AS a
  FROM pop WHERE phase IN ('before', 'during', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type)
SELECT semester, exam_type, area_id, area_name, area_type,
  {_r('b', 'before_population')}, {_r('du', 'during_population')}, {_r('a', 'after_population')},
  ROUND({_lift('b', 'du')}, 6) AS during_lift, ROUND({_lift('b', 'a')}, 6) AS after_lift
FROM s"""

ORACLE_SQL["report_young_population_lift"] = f"""{_FACTS},
s AS (
  SELECT semester, exam_type, area_id, area_name, area_type,
    {_xavg("young_20s_population", "phase = 'before'")} AS b,
    {_xavg("young_20s_population", "phase = 'after'")} AS a
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type),
l AS (SELECT *, {_lift('b', 'a')} AS lift FROM s)
SELECT semester, exam_type, area_id, area_name, area_type,
  {_r('b', 'before_young_population')}, {_r('a', 'after_young_population')}, {_r('lift', 'young_after_lift')},
  ROW_NUMBER() OVER (PARTITION BY semester, exam_type ORDER BY lift DESC NULLS LAST, area_id) AS rank_no
FROM l"""

ORACLE_SQL["report_subway_alighting_lift"] = f"""{_FACTS},
s AS (
  SELECT semester, exam_type, area_id, area_name, area_type,
    AVG(CASE WHEN phase = 'before' THEN alighting_count END) AS b,
    AVG(CASE WHEN phase = 'after' THEN alighting_count END) AS a
  FROM rid WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type),
l AS (SELECT *, {_lift('b', 'a')} AS lift FROM s)
SELECT semester, exam_type, area_id, area_name, area_type,
  {_r('b', 'before_alighting')}, {_r('a', 'after_alighting')}, {_r('lift', 'alighting_after_lift')},
  ROW_NUMBER() OVER (PARTITION BY semester, exam_type ORDER BY lift DESC NULLS LAST, area_id) AS rank_no
FROM l"""

ORACLE_SQL["report_hotplace_rank_compare"] = f"""{_FACTS},
p AS (
  SELECT semester, exam_type, area_id, area_name, area_type, {_xavg("total_population")} AS ap
  FROM pop WHERE phase = 'after' AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type),
r AS (
  SELECT semester, exam_type, area_id, AVG(alighting_count) AS aa
  FROM rid WHERE phase = 'after' AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id),
j AS (
  SELECT p.*, r.aa,
    ROW_NUMBER() OVER (PARTITION BY p.semester, p.exam_type ORDER BY p.ap DESC NULLS LAST, p.area_id) AS population_rank,
    ROW_NUMBER() OVER (PARTITION BY p.semester, p.exam_type ORDER BY r.aa DESC NULLS LAST, p.area_id) AS subway_rank
  FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.area_id = r.area_id)
SELECT semester, exam_type, area_id, area_name, area_type, {_r('ap', 'after_population')},
  {_r('aa', 'after_alighting')}, population_rank, subway_rank, population_rank - subway_rank AS rank_gap
FROM j"""

ORACLE_SQL["report_area_type_change"] = f"""{_FACTS},
p AS (
  SELECT semester, exam_type, area_type,
    {_xavg("total_population", "phase = 'before'")} AS bp,
    {_xavg("total_population", "phase = 'after'")} AS ap,
    {_xavg("young_20s_population", "phase = 'before'")} AS by_,
    {_xavg("young_20s_population", "phase = 'after'")} AS ay
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_type),
r AS (
  SELECT semester, exam_type, area_type,
    AVG(CASE WHEN phase = 'before' THEN alighting_count END) AS ba,
    AVG(CASE WHEN phase = 'after' THEN alighting_count END) AS aa
  FROM rid WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_type)
SELECT p.semester, p.exam_type, p.area_type,
  {_r('bp', 'before_population')}, {_r('ap', 'after_population')}, ROUND({_lift('bp', 'ap')}, 6) AS population_after_lift,
  {_r('by_', 'before_young_population')}, {_r('ay', 'after_young_population')}, ROUND({_lift('by_', 'ay')}, 6) AS young_after_lift,
  {_r('ba', 'before_alighting')}, {_r('aa', 'after_alighting')}, ROUND({_lift('ba', 'aa')}, 6) AS alighting_after_lift
FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.area_type = r.area_type"""

ORACLE_SQL["report_time_band_young_lift"] = f"""{_FACTS},
s AS (
  SELECT semester, exam_type, area_id, area_name, area_type, time_band,
    {_xavg("young_20s_population", "phase = 'before'")} AS b,
    {_xavg("young_20s_population", "phase = 'after'")} AS a
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type, time_band),
l AS (SELECT *, {_lift('b', 'a')} AS lift FROM s)
SELECT semester, exam_type, area_id, area_name, area_type, time_band,
  {_r('b', 'before_young_population')}, {_r('a', 'after_young_population')}, {_r('lift', 'young_after_lift')},
  ROW_NUMBER() OVER (PARTITION BY semester, exam_type, time_band ORDER BY lift DESC NULLS LAST, area_id) AS rank_no
FROM l"""

ORACLE_SQL["report_weekend_effect"] = f"""{_FACTS},
p AS (
  SELECT semester, exam_type, area_id, area_name, area_type, is_weekend,
    {_xavg("young_20s_population", "phase = 'before'")} AS by_,
    {_xavg("young_20s_population", "phase = 'after'")} AS ay
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type, is_weekend),
r AS (
  SELECT semester, exam_type, area_id, is_weekend,
    AVG(CASE WHEN phase = 'before' THEN alighting_count END) AS ba,
    AVG(CASE WHEN phase = 'after' THEN alighting_count END) AS aa
  FROM rid WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, is_weekend)
SELECT p.semester, p.exam_type, p.area_id, p.area_name, p.area_type, p.is_weekend,
  {_r('by_', 'before_young_population')}, {_r('ay', 'after_young_population')}, ROUND({_lift('by_', 'ay')}, 6) AS young_after_lift,
  {_r('ba', 'before_alighting')}, {_r('aa', 'after_alighting')}, ROUND({_lift('ba', 'aa')}, 6) AS alighting_after_lift
FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.area_id = r.area_id
  AND p.is_weekend = r.is_weekend"""

ORACLE_SQL["report_after_vs_normal"] = f"""{_FACTS},
n AS (
  SELECT area_id, area_name, area_type, {_xavg("young_20s_population")} AS ny, {_xavg("total_population")} AS nt
  FROM pop WHERE phase = 'normal' GROUP BY area_id, area_name, area_type),
a AS (
  SELECT semester, exam_type, area_id, area_name, area_type,
    {_xavg("young_20s_population")} AS ay, {_xavg("total_population")} AS at
  FROM pop WHERE phase = 'after' AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type)
SELECT a.area_id, a.area_name, a.area_type, a.semester, a.exam_type,
  {_r('n.ny', 'normal_young_population')}, {_r('a.ay', 'after_young_population')},
  ROUND({_lift('n.ny', 'a.ay')}, 6) AS young_after_vs_normal_lift,
  {_r('n.nt', 'normal_total_population')}, {_r('a.at', 'after_total_population')},
  ROUND({_lift('n.nt', 'a.at')}, 6) AS total_after_vs_normal_lift
FROM n JOIN a ON n.area_id = a.area_id"""


def _did_sql(fact: str, measure: str, suffix: str) -> str:
    treat = "('university', 'culture_university', 'university_nightlife')"
    ctrl = "('nightlife', 'nightlife_business')"
    def avg(cond: str) -> str:
        if measure in ("total_population", "young_20s_population"):
            return _xavg(measure, cond)
        return f"AVG(CASE WHEN {cond} THEN {measure} END)"

    return f"""{_FACTS},
g AS (
  SELECT semester, exam_type,
    {avg(f"area_type IN {treat} AND phase = 'before'")} AS tb,
    {avg(f"area_type IN {treat} AND phase = 'after'")} AS ta,
    {avg(f"area_type IN {ctrl} AND phase = 'before'")} AS cb,
    {avg(f"area_type IN {ctrl} AND phase = 'after'")} AS ca
  FROM {fact}
  WHERE phase IN ('before', 'after') AND semester IS NOT NULL
    AND area_type IN ('university', 'culture_university', 'university_nightlife', 'nightlife', 'nightlife_business')
  GROUP BY semester, exam_type)
SELECT semester, exam_type,
  {_r('tb', f'treatment_before_{suffix}')}, {_r('ta', f'treatment_after_{suffix}')},
  ROUND({_lift('tb', 'ta')}, 6) AS treatment_lift,
  {_r('cb', f'control_before_{suffix}')}, {_r('ca', f'control_after_{suffix}')},
  ROUND({_lift('cb', 'ca')}, 6) AS control_lift,
  ROUND(CASE WHEN tb > 0 AND cb > 0 THEN (ta - tb) / tb - (ca - cb) / cb END, 6) AS did_lift
FROM g"""


ORACLE_SQL["report_did_young_population"] = _did_sql("pop", "young_20s_population", "young")
ORACLE_SQL["report_did_subway_alighting"] = _did_sql("rid", "alighting_count", "alighting")

ORACLE_SQL["report_hotplace_score"] = f"""{_FACTS},
p AS (
  SELECT semester, exam_type, area_id, area_name, area_type,
    {_xavg("total_population", "phase = 'after'")} AS ap,
    {_xavg("young_20s_population", "phase = 'before'")} AS by_,
    {_xavg("young_20s_population", "phase = 'after'")} AS ay
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id, area_name, area_type),
r AS (
  SELECT semester, exam_type, area_id,
    AVG(CASE WHEN phase = 'before' THEN alighting_count END) AS ba,
    AVG(CASE WHEN phase = 'after' THEN alighting_count END) AS aa
  FROM rid WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_id),
j AS (
  SELECT p.semester, p.exam_type, p.area_id, p.area_name, p.area_type, p.ap,
    {_lift('p.by_', 'p.ay')} AS yl, {_lift('r.ba', 'r.aa')} AS al
  FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.area_id = r.area_id),
z AS (
  SELECT *,
    CASE WHEN STDDEV_POP(ap) OVER w > 0 THEN (ap - AVG(ap) OVER w) / STDDEV_POP(ap) OVER w END AS zp,
    CASE WHEN STDDEV_POP(yl) OVER w > 0 THEN (yl - AVG(yl) OVER w) / STDDEV_POP(yl) OVER w END AS zy,
    CASE WHEN STDDEV_POP(al) OVER w > 0 THEN (al - AVG(al) OVER w) / STDDEV_POP(al) OVER w END AS za
  FROM j WINDOW w AS (PARTITION BY semester, exam_type)),
s AS (SELECT *, zp + zy + za AS score FROM z)
SELECT semester, exam_type, area_id, area_name, area_type, {_r('ap', 'after_population')},
  {_r('yl', 'young_after_lift')}, {_r('al', 'alighting_after_lift')}, {_r('zp', 'z_population')},
  {_r('zy', 'z_young_lift')}, {_r('za', 'z_alighting_lift')}, {_r('score', 'hotplace_score')},
  ROW_NUMBER() OVER (PARTITION BY semester, exam_type ORDER BY score DESC NULLS LAST, area_id) AS hotplace_rank
FROM s"""

ORACLE_SQL["report_midterm_vs_final"] = f"""{_FACTS},
g AS (
  SELECT semester, area_id, area_name, area_type,
    {_xavg("young_20s_population", "exam_type = 'midterm' AND phase = 'before'")} AS mb,
    {_xavg("young_20s_population", "exam_type = 'midterm' AND phase = 'after'")} AS ma,
    {_xavg("young_20s_population", "exam_type = 'final' AND phase = 'before'")} AS fb,
    {_xavg("young_20s_population", "exam_type = 'final' AND phase = 'after'")} AS fa
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL AND exam_type IN ('midterm', 'final')
  GROUP BY semester, area_id, area_name, area_type),
l AS (SELECT *, {_lift('mb', 'ma')} AS ml, {_lift('fb', 'fa')} AS fl FROM g)
SELECT semester, area_id, area_name, area_type,
  {_r('mb', 'midterm_before_young')}, {_r('ma', 'midterm_after_young')}, {_r('ml', 'midterm_young_lift')},
  {_r('fb', 'final_before_young')}, {_r('fa', 'final_after_young')}, {_r('fl', 'final_young_lift')},
  ROUND(fl - ml, 6) AS final_minus_midterm_lift
FROM l"""

_PLAIN_FACTS = _FACTS
for _m in ("tot", "yng"):
    _PLAIN_FACTS = _PLAIN_FACTS.replace(f"CAST(SUM(CAST(ROUND(o.{_m} * 100) AS BIGINT)) AS DOUBLE) / 100.0", f"SUM(o.{_m})")

ORACLE_SQL["fact_population_plain"] = f"""{_PLAIN_FACTS}
SELECT date, year, month, day_of_week, day_of_week_num, is_weekend, hour, time_band, area_id, area_name,
       area_type, phase, exam_type, semester, ROUND(total_population + 1e-7, 3) AS total_population,
       ROUND(young_20s_population + 1e-7, 3) AS young_20s_population, ROUND(young_20s_ratio + 1e-7, 3) AS young_20s_ratio
FROM pop"""

ORACLE_SQL["report_area_type_change_plain"] = f"""{_PLAIN_FACTS},
p AS (
  SELECT semester, exam_type, area_type,
    AVG(CASE WHEN phase = 'before' THEN total_population END) AS bp,
    AVG(CASE WHEN phase = 'after' THEN total_population END) AS ap,
    AVG(CASE WHEN phase = 'before' THEN young_20s_population END) AS by_,
    AVG(CASE WHEN phase = 'after' THEN young_20s_population END) AS ay
  FROM pop WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_type),
r AS (
  SELECT semester, exam_type, area_type,
    AVG(CASE WHEN phase = 'before' THEN alighting_count END) AS ba,
    AVG(CASE WHEN phase = 'after' THEN alighting_count END) AS aa
  FROM rid WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type, area_type)
SELECT p.semester, p.exam_type, p.area_type,
  ROUND(bp + 1e-7, 3) AS before_population, ROUND(ap + 1e-7, 3) AS after_population, ROUND({_lift('bp', 'ap')} + 1e-7, 3) AS population_after_lift,
  ROUND(by_ + 1e-7, 3) AS before_young_population, ROUND(ay + 1e-7, 3) AS after_young_population, ROUND({_lift('by_', 'ay')} + 1e-7, 3) AS young_after_lift,
  ROUND(ba + 1e-7, 3) AS before_alighting, ROUND(aa + 1e-7, 3) AS after_alighting, ROUND({_lift('ba', 'aa')} + 1e-7, 3) AS alighting_after_lift
FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.area_type = r.area_type"""

ORACLE_SQL["lattice_population"] = f"""{_FACTS}
SELECT area_id, area_name, area_type, semester, exam_type, phase, time_band, is_weekend,
  CAST(SUM(CAST(ROUND(total_population * 100) AS BIGINT)) AS BIGINT) AS total_population_sum, COUNT(total_population) AS total_population_n,
  CAST(SUM(CAST(ROUND(young_20s_population * 100) AS BIGINT)) AS BIGINT) AS young_20s_population_sum, COUNT(young_20s_population) AS young_20s_population_n
FROM pop GROUP BY ALL"""
for _name in LATTICE_QUERIES:
    if _name != "lattice_population":
        ORACLE_SQL[_name] = ORACLE_SQL["report_" + _name.removeprefix("lattice_")]

ORACLE_SQL["fact_population_stable"] = ORACLE_SQL["fact_population"]
ORACLE_SQL["report_area_type_change_stable"] = ORACLE_SQL["report_area_type_change_plain"]
