"""Raw feed parsing: population (long, UTF-8) and ridership (wide, CP949) CSVs
to observations ``(date, hour, unit_code, measures...)``.

Column resolution happens on the schema only (driver side, no job); parsing is
built-in expressions with ``try_*`` semantics so that bad cells become NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lenient_date, parse_count, safe_row_sum, strict_date, try_integer, try_number
from ..sources.csv import resolve_columns
from .reshape import columns_to_rows

# ---------------------------------------------------------------------------
# Native column names and labels of the two raw feeds.
# ---------------------------------------------------------------------------
# Population feed (one row per date, hour and administrative unit).
PEOPLE_DATE = "기준일ID"
PEOPLE_HOUR = "시간대구분"
PEOPLE_UNIT = "행정동코드"
PEOPLE_TOTAL = "총생활인구수"
PEOPLE_YOUNG = [
    "남자20세부터24세생활인구수",
    "남자25세부터29세생활인구수",
    "여자20세부터24세생활인구수",
    "여자25세부터29세생활인구수",
]
PEOPLE_DATE_FORMAT = "yyyyMMdd"

# Ridership feed (one row per date, line, station, direction, passenger type;
# one column per hour). Candidates are tried in order; hours 1 and 2 are optional.
SUBWAY_DATE = "수송일자"
SUBWAY_LINE_CANDIDATES = ["호선명", "호선"]
SUBWAY_STATION = "역명"
SUBWAY_DIRECTION = "승하차구분"
SUBWAY_PASSENGER_TYPE = "승객유형"
SUBWAY_EXIT_LABEL = "하차"
SUBWAY_HOUR_CANDIDATES = [
    (18, ["18시", "18-19시간대"]),
    (19, ["19시", "19-20시간대"]),
    (20, ["20시", "20-21시간대"]),
    (21, ["21시", "21-22시간대"]),
    (22, ["22시", "22-23시간대"]),
    (23, ["23시", "23-24시간대"]),
    (0, ["00시", "24시간대이후"]),
    (1, ["01시"]),
    (2, ["02시"]),
]
SUBWAY_OPTIONAL_HOURS = (1, 2)


#: column -> names it may have in a header, best first, and the columns a header may lack: for readers that resolve layouts
PEOPLE_WANTED = {c: [c] for c in [PEOPLE_DATE, PEOPLE_HOUR, PEOPLE_UNIT, PEOPLE_TOTAL, *PEOPLE_YOUNG]}
SUBWAY_WANTED = {
    **{c: [c] for c in (SUBWAY_DATE, SUBWAY_STATION, SUBWAY_DIRECTION, SUBWAY_PASSENGER_TYPE)},
    SUBWAY_LINE_CANDIDATES[0]: SUBWAY_LINE_CANDIDATES,
    **{names[0]: names for _, names in SUBWAY_HOUR_CANDIDATES},
}
SUBWAY_OPTIONAL = [names[0] for hour, names in SUBWAY_HOUR_CANDIDATES if hour in SUBWAY_OPTIONAL_HOURS]


def people_observations(raw: DataFrame) -> DataFrame:
    """Population CSV rows -> ``date, hour, unit_code, total_population,
    young_20s_population`` (P1, P2, P7).

    A bad total becomes NULL (skipped by SUM); a bad age cell counts as 0 in the
    young sum; bad dates or hours become NULL and are dropped by the roll-up.
    """
    resolve_columns(raw.columns, PEOPLE_WANTED)
    return raw.select(
        strict_date(PEOPLE_DATE, PEOPLE_DATE_FORMAT).alias("date"),
        try_integer(PEOPLE_HOUR, "int").alias("hour"),
        F.col(PEOPLE_UNIT).cast("string").alias("unit_code"),
        try_number(PEOPLE_TOTAL, "double").alias("total_population"),
        safe_row_sum([try_number(c, "double") for c in PEOPLE_YOUNG]).alias("young_20s_population"),
    )


def subway_columns(columns: list[str]) -> tuple[dict, list[tuple[int, str]]]:
    """(names of the key columns, (hour, name) of the hour columns present); an error
    lists every required one that is missing (P3, Q2)."""
    keys = {c: [c] for c in (SUBWAY_DATE, SUBWAY_STATION, SUBWAY_DIRECTION, SUBWAY_PASSENGER_TYPE)}
    wanted = {**keys, "line name": SUBWAY_LINE_CANDIDATES, **dict(SUBWAY_HOUR_CANDIDATES)}
    found = resolve_columns(columns, wanted, SUBWAY_OPTIONAL_HOURS)
    return found, [(hour, found[hour]) for hour, _ in SUBWAY_HOUR_CANDIDATES if hour in found]


def subway_observations(raw: DataFrame) -> DataFrame:
    """Wide ridership CSV rows -> ``date, hour, raw_station_name, passenger_type,
    alighting_count`` (F3, P4-P7).

    Only exit rows are kept (direction trimmed); each hour column becomes a row;
    counts drop thousands separators; the date keeps its digits only. Rows with
    an unparsable date or count are dropped.
    """
    _, hours = subway_columns(raw.columns)
    exits = raw.filter(F.trim(F.col(SUBWAY_DIRECTION)) == SUBWAY_EXIT_LABEL)
    long = columns_to_rows(
        exits,
        [
            lenient_date(SUBWAY_DATE).alias("date"),
            F.trim(F.col(SUBWAY_STATION)).alias("raw_station_name"),
            F.trim(F.col(SUBWAY_PASSENGER_TYPE)).alias("passenger_type"),
        ],
        hours,
        key="hour",
        value="alighting_count",
        parse=parse_count,
    )
    return long.filter(F.col("date").isNotNull() & F.col("alighting_count").isNotNull())
