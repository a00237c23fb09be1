"""Small dimension tables: area mapping, period calendar, station names.

These are the inputs the analysis is defined by. They are tiny (tens of rows) and
are built on the driver from literal rows or read from small CSV files; joins to
them go through :func:`periodlens.operators.joins.join_dimension`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_header_name, try_integer

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as below to reproduce the analysis).
# ---------------------------------------------------------------------------

AREA_MAPPING_COLUMNS = [
    "area_id", "area_name", "area_type", "dong_code", "dong_name", "station_name", "line_name", "notes",
]
AREA_MAPPING_ROWS = [
    ("hongdae", "hongdae_sangsu_hapjeong", "nightlife", "11440660", "seogyo_dong", "hongik_univ", "line_2", "main hongdae commercial area"),
    ("hongdae", "hongdae_sangsu_hapjeong", "nightlife", "11440680", "hapjeong_dong", "hapjeong", "line_2", "hapjeong station area"),
    ("hongdae", "hongdae_sangsu_hapjeong", "nightlife", "11440655", "seogang_dong", "sangsu", "line_6", "sangsu station area"),
    ("shinchon", "shinchon_ewha", "university", "11410585", "shinchon_dong", "shinchon", "line_2", "main shinchon university district"),
    ("shinchon", "shinchon_ewha", "university", "11410585", "shinchon_dong", "ewha_womans_univ", "line_2", "ewha station mapped to shinchon dong"),
    ("konkuk", "konkuk_univ", "university_nightlife", "11215710", "hwayang_dong", "konkuk_univ", "line_2", "konkuk university nightlife district"),
    ("konkuk", "konkuk_univ", "university_nightlife", "11215847", "jayang4_dong", "konkuk_univ", "line_7", "south side of konkuk university station"),
    ("daehakro", "daehakro_hyehwa", "culture_university", "11110650", "hyehwa_dong", "hyehwa", "line_4", "daehakro culture and university district"),
    ("snu", "seoul_nat_univ_syarosu", "university", "11620575", "haengun_dong", "seoul_nat_univ_gwanakgu_office", "line_2", "seoul national university station area"),
    ("snu", "seoul_nat_univ_syarosu", "university", "11620595", "cheongnyong_dong", "seoul_nat_univ_gwanakgu_office", "line_2", "syarosu-gil nearby area"),
    ("gangnam", "gangnam_yeoksam", "nightlife_business", "11680640", "yeoksam1_dong", "gangnam", "line_2", "gangnam station nightlife and business district"),
    ("gangnam", "gangnam_yeoksam", "nightlife_business", "11680650", "yeoksam2_dong", "yeoksam", "line_2", "yeoksam station business district"),
    ("itaewon", "itaewon", "nightlife", "11170650", "itaewon1_dong", "itaewon", "line_6", "main itaewon nightlife district"),
    ("itaewon", "itaewon", "nightlife", "11170660", "itaewon2_dong", "noksapyeong_yongsangu_office", "line_6", "noksapyeong station nearby area"),
]

EXAM_PERIOD_COLUMNS = ["year", "semester", "exam_type", "phase", "start_date", "end_date", "notes"]
EXAM_PERIOD_ROWS = [
    ("2025", "1", "midterm", "before", "2025-04-14", "2025-04-20", "7 days before exam"),
    ("2025", "1", "midterm", "during", "2025-04-21", "2025-04-30", "midterm exam period"),
    ("2025", "1", "midterm", "after", "2025-05-01", "2025-05-07", "7 days after exam"),
    ("2025", "1", "final", "before", "2025-06-02", "2025-06-08", "7 days before exam"),
    ("2025", "1", "final", "during", "2025-06-09", "2025-06-16", "final exam period"),
    ("2025", "1", "final", "after", "2025-06-17", "2025-06-23", "7 days after exam"),
    ("2025", "2", "midterm", "before", "2025-10-13", "2025-10-19", "7 days before exam"),
    ("2025", "2", "midterm", "during", "2025-10-20", "2025-10-27", "midterm exam period"),
    ("2025", "2", "midterm", "after", "2025-10-28", "2025-11-03", "7 days after exam"),
    ("2025", "2", "final", "before", "2025-11-29", "2025-12-05", "7 days before exam"),
    ("2025", "2", "final", "during", "2025-12-06", "2025-12-12", "final exam period"),
    ("2025", "2", "final", "after", "2025-12-13", "2025-12-19", "7 days after exam"),
    ("2026", "1", "midterm", "before", "2026-04-13", "2026-04-19", "7 days before exam"),
    ("2026", "1", "midterm", "during", "2026-04-20", "2026-04-27", "midterm exam period"),
    ("2026", "1", "midterm", "after", "2026-04-28", "2026-04-30", "partial after period because May 2026 data is not available"),
]

# Native station name (as printed in the ridership feed) -> mapping station id.
STATION_NAME_ROWS = [
    ("홍대입구", "hongik_univ"),
    ("합정", "hapjeong"),
    ("상수", "sangsu"),
    ("신촌", "shinchon"),
    ("이대", "ewha_womans_univ"),
    ("건대입구", "konkuk_univ"),
    ("혜화", "hyehwa"),
    ("서울대입구(관악구청)", "seoul_nat_univ_gwanakgu_office"),
    ("강남", "gangnam"),
    ("역삼", "yeoksam"),
    ("이태원", "itaewon"),
    ("녹사평(용산구청)", "noksapyeong_yongsangu_office"),
]

# Treatment and control groups of the difference-in-differences reports.
TREATMENT_AREA_TYPES = ("university", "culture_university", "university_nightlife")
CONTROL_AREA_TYPES = ("nightlife", "nightlife_business")

# Phase labels of the calendar, and the label of days outside every period.
PHASES = ("before", "during", "after")
NORMAL = "normal"

STRING_SCHEMA = lambda cols: T.StructType([T.StructField(c, T.StringType(), True) for c in cols])

PERIOD_SCHEMA = T.StructType(
    [
        T.StructField("exam_year", T.IntegerType(), True),
        T.StructField("semester", T.IntegerType(), True),
        T.StructField("exam_type", T.StringType(), True),
        T.StructField("phase", T.StringType(), True),
        T.StructField("start_date", T.DateType(), True),
        T.StructField("end_date", T.DateType(), True),
    ]
)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A literal table as a ``LocalRelation`` (shipped in the plan, exact size
    statistics, no RDD), built through Arrow from the driver-side rows."""
    import pandas as pd

    pdf = pd.DataFrame.from_records(rows, columns=schema.names)
    return spark.createDataFrame(pdf, schema)


def area_mapping_raw(spark: SparkSession) -> DataFrame:
    """The shipped area mapping as all-string rows."""
    return local_table(spark, AREA_MAPPING_ROWS, STRING_SCHEMA(AREA_MAPPING_COLUMNS))


def exam_periods_raw(spark: SparkSession) -> DataFrame:
    """The shipped exam calendar as all-string rows."""
    return local_table(spark, EXAM_PERIOD_ROWS, STRING_SCHEMA(EXAM_PERIOD_COLUMNS))


def station_names(spark: SparkSession) -> DataFrame:
    """Native station name -> station id."""
    return local_table(spark, STATION_NAME_ROWS, STRING_SCHEMA(["raw_station_name", "station_name"]))


def write_dimension_csvs(spark: SparkSession, folder: str) -> dict[str, str]:
    """Write both dimension CSVs (header, UTF-8) below ``folder`` (S9), as
    ``area_mapping.csv`` and ``exam_periods.csv`` (Spark output folders; both
    readable by path like single files)."""
    paths = {"area_mapping": f"{folder}/area_mapping.csv", "exam_periods": f"{folder}/exam_periods.csv"}
    area_mapping_raw(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(paths["area_mapping"])
    exam_periods_raw(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(paths["exam_periods"])
    return paths


def read_small_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column a string, header names cleaned."""
    df = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").csv(path)
    return df.toDF(*[clean_header_name(c) for c in df.columns])


def units_to_areas(mapping: DataFrame) -> DataFrame:
    """(unit_code, area_id, area_name, area_type) from an area mapping, one row per
    (area_id, unit) (S3, A15). A unit listed under two areas stays in both."""
    return (
        mapping.select(
            "area_id", "area_name", "area_type", F.col("dong_code").cast("string").alias("unit_code")
        ).dropDuplicates(["area_id", "unit_code"])
    )


def stations_to_areas(mapping: DataFrame) -> DataFrame:
    """(station_name, area_id, area_name, area_type), one row per (area_id, station)."""
    return (
        mapping.select("area_id", "area_name", "area_type", F.trim(F.col("station_name")).alias("station_name"))
        .dropDuplicates(["area_id", "station_name"])
    )


def typed_periods(periods: DataFrame) -> DataFrame:
    """Calendar rows typed (S4): numbers parse like a non-ANSI cast ("1.0" -> 1);
    bad numbers and dates become NULL, never errors."""
    return periods.select(
        try_integer("year").alias("exam_year"),
        try_integer("semester").alias("semester"),
        F.col("exam_type").cast("string").alias("exam_type"),
        F.col("phase").cast("string").alias("phase"),
        F.try_to_date(F.col("start_date").cast("string")).alias("start_date"),
        F.try_to_date(F.col("end_date").cast("string")).alias("end_date"),
    )


def calendar_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A typed calendar from (exam_year, semester, exam_type, phase, start, end) tuples."""
    return local_table(spark, rows, PERIOD_SCHEMA)
