"""Adapters from the driver's test tables to the library's inputs.

The test tables have no population feed, so the same operators run on this
stand-in (the mapping is fixed; see the README):

* observation (date, hour): ``events.ts``;
* unit -> area: ``events.user_id = customer.c_custkey`` -> ``nation`` (area) ->
  ``region`` (area type);
* total population: SUM(value); young population: the value of ``view`` and
  ``click`` events (0 otherwise); exits: one per ``purchase`` event;
* calendar: the fixed 2024 calendar below; the rest of January is ``normal``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import safe_row_sum
from ..operators.joins import join_dimension
from .dimensions import calendar_from_rows

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the stand-in mapping.
# Region name -> area type.
REGION_AREA_TYPES = [
    ("AFRICA", "university"),
    ("AMERICA", "culture_university"),
    ("ASIA", "university_nightlife"),
    ("EUROPE", "nightlife"),
    ("MIDDLE EAST", "nightlife_business"),
]
# Event types counted as the young population.
YOUNG_EVENT_TYPES = ("view", "click")
# Event type counted as one exit.
EXIT_EVENT_TYPE = "purchase"
# Calendar of the event month: (exam_year, semester, exam_type, phase, start, end).
EVENT_CALENDAR = [
    (2024, 1, "midterm", "before", "2024-01-03", "2024-01-07"),
    (2024, 1, "midterm", "during", "2024-01-08", "2024-01-12"),
    (2024, 1, "midterm", "after", "2024-01-13", "2024-01-17"),
    (2024, 1, "final", "before", "2024-01-18", "2024-01-21"),
    (2024, 1, "final", "during", "2024-01-22", "2024-01-24"),
    (2024, 1, "final", "after", "2024-01-25", "2024-01-28"),
]
# Calendar of the order dates: the same semester and exam type in two years, for
# the pooled vs by-year comparison.
ORDER_CALENDAR = [
    (1996, 1, "midterm", "before", "1996-04-01", "1996-04-14"),
    (1996, 1, "midterm", "after", "1996-04-22", "1996-05-05"),
    (1997, 1, "midterm", "before", "1997-04-01", "1997-04-14"),
    (1997, 1, "midterm", "after", "1997-04-22", "1997-05-05"),
]
# Value precision of the test tables (cents), and the fact measures carrying it.
VALUE_SCALE = 2
MEASURE_SCALES = {"total_population": VALUE_SCALE, "young_20s_population": VALUE_SCALE}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, listed anew by every query, so files added later are seen; only its
    column types are inferred once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _dates(rows):
    return [(y, s, e, p, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for y, s, e, p, a, b in rows]


def event_calendar(spark: SparkSession) -> DataFrame:
    return calendar_from_rows(spark, _dates(EVENT_CALENDAR))


def order_calendar(spark: SparkSession) -> DataFrame:
    return calendar_from_rows(spark, _dates(ORDER_CALENDAR))


def area_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region -> (nationkey, area_id, area_name, area_type); 25 rows.

    The region -> area type lookup is a literal map expression (no join stage)."""
    types = F.create_map(*[F.lit(x) for pair in REGION_AREA_TYPES for x in pair])
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), types[F.col("r_name")].alias("area_type")
    )
    nation = table(spark, sf_dir, "nation")
    return join_dimension(nation, region, "n_regionkey").select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_nationkey").cast("string").alias("area_id"),
        F.col("n_name").alias("area_name"),
        F.col("area_type"),
    )


def unit_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit (customer) -> area: (unit_code, area_id, area_name, area_type).

    The customer table grows with the data; how it meets the nations is the planner's choice.
    """
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("unit_code"), F.col("c_nationkey").alias("nationkey")
    )
    areas = area_of_nation(spark, sf_dir)
    return join_dimension(customer, areas, "nationkey").drop("nationkey")


def event_observations(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> (date, hour, unit_code, total_population, young_20s_population), and the columns to ``keep``."""
    e = table(spark, sf_dir, "events")
    young_parts = [F.when(F.col("event_type") == t, F.col("value")) for t in YOUNG_EVENT_TYPES]
    return e.select(
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("user_id").alias("unit_code"),
        F.col("value").alias("total_population"),
        safe_row_sum(young_parts).alias("young_20s_population"),
        *keep,
    )


def exit_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase events -> (date, hour, unit_code, alighting_count = 1)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == EXIT_EVENT_TYPE)
    return e.select(
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("user_id").alias("unit_code"),
        F.lit(1).cast("long").alias("alighting_count"),
    )


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (date, hour, unit_code, total_population = price, young = 0). Order dates have
    no time of day, so the hour is the order key modulo 24."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.to_date("o_orderdate").alias("date"),
        F.pmod("o_orderkey", F.lit(24)).cast("int").alias("hour"),
        F.col("o_custkey").alias("unit_code"),
        F.col("o_totalprice").alias("total_population"),
        F.lit(0.0).alias("young_20s_population"),
    )
