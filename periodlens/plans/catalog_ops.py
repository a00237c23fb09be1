"""Operator-level catalog entries (beyond the fact builds and reports).

Each entry exercises one group of operators on the whole test tables, or on data
Spark derives from them (CSV files written to the shared staging folder and read
back through the raw-feed readers). Oracle SQL texts are written independently.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    date_parts,
    guarded_ratio,
    in_night_window,
    lenient_date,
    lift,
    parse_count,
    safe_row_sum,
    time_band,
    to_units,
    try_number,
)
from ..operators.facts import Measure, population_fact, ridership_fact
from ..operators.joins import join_dimension
from ..operators.ingest import (
    SUBWAY_OPTIONAL,
    SUBWAY_WANTED,
    PEOPLE_DATE,
    PEOPLE_HOUR,
    PEOPLE_TOTAL,
    PEOPLE_UNIT,
    PEOPLE_YOUNG,
    SUBWAY_DATE,
    SUBWAY_DIRECTION,
    SUBWAY_EXIT_LABEL,
    SUBWAY_HOUR_CANDIDATES,
    SUBWAY_PASSENGER_TYPE,
    SUBWAY_STATION,
    people_observations,
    subway_observations,
)
from ..operators.metrics import group_phase_avg, phase_avg, ranked, top_k_per_group
from ..operators.parts import load, read_folded
from ..operators.periods import label_periods, overlapping_periods
from ..operators.quality import Gates, existence
from ..operators.rejects import ACCEPTED, REJECTED, people_rules, read_split, with_reason, write_split
from ..operators.reshape import columns_to_rows, rows_to_columns
from ..session import staging_path
from ..sinks import (
    EXPORT_FORMAT,
    create_database,
    drop_table,
    export_delimited,
    export_report,
    register_fact_table,
    register_partitions,
    save_table,
    write_parquet,
)
from ..sources import testdata as td
from ..sources.csv import CsvLayout, detect_encodings, normalize_to_utf8, read_csv_layouts, read_csv_strings
from ..sources.manifest import read_csv_manifest, read_manifest, update_manifest
from ..sources.dimensions import (
    calendar_from_rows,
    local_table,
    read_small_csv,
    stations_to_areas,
    typed_periods,
    units_to_areas,
)
from .catalog import (
    SQL_CALENDAR,
    SQL_FACTS,
    SQL_UNITS,
    ORACLE_SQL as REPORT_SQL,
    event_facts,
    event_population_fact,
    _xavg,
    rounded,
    sql_population,
)
from .pipelines import station_units
from .reports import (
    REPORTS,
    area_type_change,
    did_subway_alighting,
    hotplace_rank_compare,
    population_phase_change,
    young_population_lift,
)

NIGHT_HOURS = [18, 19, 20, 21, 22, 23, 0, 1, 2]


def _events_dated(spark, sf):
    e = td.table(spark, sf, "events")
    return e.select("event_id", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"), "user_id", "event_type", "value")


# ---------------------------------------------------------------------------
# Period labelling
# ---------------------------------------------------------------------------

# Fixed value: one extra period overlapping the midterm windows, for the fan-out case.
OVERLAP_EXTRA = (2024, 1, "festival", "during", "2024-01-10", "2024-01-14")


def _labelled_events(spark, sf, strategy, rows=None):
    rows = rows or td.EVENT_CALENDAR
    dated = [(y, s, e, p, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for y, s, e, p, a, b in rows]
    cal = calendar_from_rows(spark, dated)
    ev = _events_dated(spark, sf).select("event_id", "date")
    out = label_periods(ev, cal, "date", strategy)
    return out.select("event_id", "date", "exam_year", "semester", "exam_type", "phase")


def label_periods_expanded(spark, sf):
    return _labelled_events(spark, sf, "expanded")


def label_periods_range(spark, sf):
    return _labelled_events(spark, sf, "range")


def label_periods_overlap(spark, sf):
    return _labelled_events(spark, sf, "expanded", td.EVENT_CALENDAR + [OVERLAP_EXTRA])


def order_week_calendar(spark, sf) -> DataFrame:
    """A calendar derived from the orders: one week-long period per order, labelled
    (order year, half-year, priority, status)."""
    o = td.table(spark, sf, "orders")
    start = F.to_date("o_orderdate")
    return o.select(
        F.year(start).alias("exam_year"),
        F.when(F.month(start) <= 6, 1).otherwise(2).alias("semester"),
        F.col("o_orderpriority").alias("exam_type"),
        F.col("o_orderstatus").alias("phase"),
        start.alias("start_date"),
        F.date_add(start, 6).alias("end_date"),
    )


def calendar_overlap_check(spark, sf):
    return overlapping_periods(order_week_calendar(spark, sf))


# ---------------------------------------------------------------------------
# Column functions
# ---------------------------------------------------------------------------


def time_bands(spark, sf):
    ev = _events_dated(spark, sf)
    return ev.select("event_id", "hour", time_band("hour").alias("time_band"), in_night_window("hour").alias("is_night"))


def date_parts_query(spark, sf):
    ev = _events_dated(spark, sf)
    parts = date_parts("date")
    return ev.select("event_id", "date", *[c.alias(k) for k, c in parts.items()])


def parse_thousands(spark, sf):
    o = td.table(spark, sf, "orders")
    text = o.select("o_orderkey", F.format_number(F.floor("o_totalprice"), 0).alias("amount_text"))
    return text.select("o_orderkey", parse_count("amount_text").alias("amount"))


def parse_dates_lenient(spark, sf):
    o = td.table(spark, sf, "orders")
    text = o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy.MM.dd").alias("dotted"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-31")).alias("day31"),
    )
    return text.select(
        "o_orderkey", lenient_date("dotted").alias("order_date"), lenient_date("day31").alias("month_day_31")
    ).filter(F.col("order_date").isNotNull())


def safe_row_sum_query(spark, sf):
    o = td.table(spark, sf, "orders")
    cells = [F.col("o_totalprice").cast("string"), F.col("o_orderpriority"), F.col("o_custkey").cast("string")]
    return rounded(o.select("o_orderkey", safe_row_sum([try_number(c, "double") for c in cells]).alias("row_sum")))


def lift_null_base(spark, sf):
    o = td.table(spark, sf, "orders")

    def cents(status):
        return F.sum(F.when(F.col("o_orderstatus") == status, F.round(F.col("o_totalprice") * 100).cast("long")).otherwise(0))

    per = o.groupBy("o_custkey").agg((cents("F") / 100.0).alias("base"), (cents("O") / 100.0).alias("new"))
    return rounded(
        per.select("o_custkey", "base", "new", lift("base", "new").alias("lift"), guarded_ratio("new", "base").alias("ratio"))
    )


# ---------------------------------------------------------------------------
# Fact options
# ---------------------------------------------------------------------------


def late_night_previous_day(spark, sf):
    return rounded(event_population_fact(spark, sf, late_night="previous_day"))


def _order_fact(spark, sf, by_year):
    units = td.unit_areas(spark, sf)
    return population_fact(
        td.order_observations(spark, sf), units, td.order_calendar(spark), scale=td.VALUE_SCALE,
        by_year=by_year,
    )


def _order_ridership_fact(spark, sf, by_year):
    obs = td.order_observations(spark, sf).select("date", "hour", "unit_code", F.lit(1).cast("long").alias("alighting_count"))
    return ridership_fact(obs, td.unit_areas(spark, sf), td.order_calendar(spark), by_year=by_year)


def rank_compare_by_exam_year(spark, sf):
    """R4 with the calendar year as a key on both facts and in the join."""
    pop = _order_fact(spark, sf, True)
    rid = _order_ridership_fact(spark, sf, True)
    return rounded(hotplace_rank_compare(pop, rid, by_year=True, scales=td.MEASURE_SCALES))


def did_exits_by_exam_year(spark, sf):
    """R10 (difference in differences of exits) with the calendar year as a key."""
    return rounded(did_subway_alighting(None, _order_ridership_fact(spark, sf, True), by_year=True))


def pooled_by_exam(spark, sf):
    return rounded(population_phase_change(_order_fact(spark, sf, False), None, scales=td.MEASURE_SCALES))


def pooled_by_exam_year(spark, sf):
    return rounded(population_phase_change(_order_fact(spark, sf, True), None, by_year=True, scales=td.MEASURE_SCALES))


# ---------------------------------------------------------------------------
# Reshaping, raw CSV feeds, dimensions
# ---------------------------------------------------------------------------


def _source_observations(spark, sf):
    """Event observations, each event type a source of its own."""
    obs = td.event_observations(spark, sf, keep=("event_type",))
    return obs.withColumnRenamed("event_type", "source")


def fact_population_incremental(spark, sf):
    """A fact kept by loads: first all sources but one, of which one holds wrong values and a day that isn't its own; then the
    corrected source; then the late one. Equals ``fact_population``."""
    obs, units = _source_observations(spark, sf), td.unit_areas(spark, sf)
    measures = [Measure("total_population", td.VALUE_SCALE), Measure("young_20s_population", td.VALUE_SCALE)]

    def build(rows):
        return population_fact(rows, units, td.event_calendar(spark), scale=td.VALUE_SCALE)

    store = staging_path(spark, "fact-store")
    wrong = F.col("source") == "click"
    first = obs.filter("source <> 'purchase'").withColumns(
        {"total_population": F.when(wrong, F.col("total_population") + 1).otherwise(F.col("total_population")), "date": F.when(wrong, F.date_add("date", 400)).otherwise(F.col("date"))}
    )
    for rows in (first, obs.filter("source = 'click'"), obs.filter("source = 'purchase'")):
        load(spark, store, rows, measures, build)
    return rounded(read_folded(spark, store, build(obs.drop("source")).schema))


def rejected_rows_by_reason(spark, sf):
    """A population feed with broken cells, read back, split into accepted and rejected rows in one write; rows per reason.
    Purchases break: by hour of day the date, the hour, the unit or the total, some two of them (the first one counts)."""
    ev = _events_dated(spark, sf)
    hit = F.col("event_type") == "purchase"

    def broken(hours, bad, good):
        return F.when(hit & F.col("hour").isin(*hours), F.lit(bad)).otherwise(good)

    feed = ev.select(
        broken([0, 1], "2024013", broken([2], " ", F.date_format("date", "yyyyMMdd"))).alias(PEOPLE_DATE),
        broken([1, 3, 4], "25", broken([5], "", F.col("hour").cast("string"))).alias(PEOPLE_HOUR),
        broken([6, 7], " ", F.col("user_id").cast("string")).alias(PEOPLE_UNIT),
        broken([7, 8, 9], "n/a", F.col("value").cast("string")).alias(PEOPLE_TOTAL),
    )
    path = staging_path(spark, "people-broken")
    feed.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/feed")
    rules = people_rules()
    checked = with_reason(read_csv_strings(spark, f"{path}/feed"), rules)
    write_split(checked, rules, f"{path}/split")
    rejected = read_split(spark, f"{path}/split", REJECTED, checked).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    accepted = read_split(spark, f"{path}/split", ACCEPTED, checked).agg(F.count(F.lit(1)).alias("n_rows"))
    return rejected.unionByName(accepted.select(F.lit(ACCEPTED).alias("reason"), "n_rows"))


def top_orders_per_segment(spark, sf, k: int = 25):
    """The k dearest orders of each market segment (W1, O3): k rows a group leave each task."""
    o = td.table(spark, sf, "orders").join(td.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    top = top_k_per_group(o, ["c_mktsegment"], [F.desc("o_totalprice"), F.asc("o_orderkey")], k)
    return rounded(top.select("c_mktsegment", "rank_no", "o_orderkey", "o_totalprice"))


def partitioned_table_roundtrip(spark, sf):
    """A fact as a PARTITIONED BY table (S6, K4): the first load's partitions registered at once, the rest after a second load."""
    pop, _ = event_facts(spark, sf)
    base = staging_path(spark, "partitioned")
    pop.write.parquet(f"{base}/plain")
    pop = spark.read.parquet(f"{base}/plain")
    db, path, by = "periodlens_" + base.rsplit("-", 1)[-1], f"{base}/area_population", ("year", "month", "day_of_week_num")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{base}/warehouse'")
    weekend = F.col("is_weekend")
    write_parquet(pop.filter(weekend), path, by)
    register_fact_table(spark, db, "area_population", path, by)
    write_parquet(pop.filter(~weekend), path, by, replace_partitions_only=True)
    register_partitions(spark, db, "area_population")
    return rounded(spark.table(f"{db}.area_population").select(*pop.columns))


def calendar_overlap_days(spark, sf):
    """The calendar check by a row per period and day; equals the sweep."""
    return overlapping_periods(order_week_calendar(spark, sf), method="days")


def unpivot_hours(spark, sf):
    ev = _events_dated(spark, sf).filter(in_night_window("hour"))
    per = ev.select("date", F.col("user_id").alias("unit_code"), "hour", F.lit(1).cast("long").alias("n"))
    wide = rows_to_columns(per, ["date", "unit_code"], "hour", "n", NIGHT_HOURS)
    long = columns_to_rows(wide, ["date", "unit_code"], [(h, f"h{h:02d}") for h in NIGHT_HOURS], "hour", "events")
    return long.filter(F.col("events").isNotNull())


def population_from_csv(spark, sf):
    """Events written as a population feed (UTF-8, BOM in the header, a bad and an
    empty age cell), read back through the raw reader; equals ``fact_population``."""
    ev = _events_dated(spark, sf)

    def cents(cond):
        return F.sum(F.when(cond, F.round(F.col("value") * 100).cast("long")))

    per = ev.groupBy("date", "hour", "user_id").agg(
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("tot"),
        cents(F.col("event_type") == "view").alias("v"),
        cents(F.col("event_type") == "click").alias("c"),
    )

    def text(c):
        return F.format_string("%.2f", F.col(c) / 100.0)

    feed = per.select(
        F.date_format("date", "yyyyMMdd").alias("\ufeff" + PEOPLE_DATE),
        F.col("hour").cast("string").alias(PEOPLE_HOUR),
        F.col("user_id").cast("string").alias(PEOPLE_UNIT),
        text("tot").alias(PEOPLE_TOTAL),
        text("v").alias(PEOPLE_YOUNG[0]),
        text("c").alias(PEOPLE_YOUNG[1]),
        F.lit("*").alias(PEOPLE_YOUNG[2]),
        F.lit(None).cast("string").alias(PEOPLE_YOUNG[3]),
    )
    path = staging_path(spark, "people-feed")
    feed.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    obs = read_csv_layouts(spark, path, per_layout=people_observations)
    units = td.unit_areas(spark, sf).withColumn("unit_code", F.col("unit_code").cast("string"))
    return rounded(population_fact(obs, units, td.event_calendar(spark), scale=td.VALUE_SCALE))


# Layout B of the ridership feed: alternative hour names (the second candidate
# where there is one) and a different line-name header.
def _layout_b_hours():
    return [(h, cands[1] if len(cands) > 1 else cands[0]) for h, cands in SUBWAY_HOUR_CANDIDATES]


def _layout_a_hours():
    return [(h, cands[0]) for h, cands in SUBWAY_HOUR_CANDIDATES]


def _write_ridership_feed(spark, sf) -> list[CsvLayout]:
    """Events written as a wide ridership feed in two header layouts and two
    charsets (first half of each month UTF-8 layout A, the rest CP949 layout B with
    reversed columns), with blanks around stations and directions. Returns the two folders."""
    ev = _events_dated(spark, sf)
    areas = td.area_of_nation(spark, sf)
    cust = td.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nationkey"))
    located = join_dimension(ev.join(cust, "user_id"), areas.select("nationkey", "area_name"), "nationkey")
    located = located.filter(in_night_window("hour")).withColumn(
        "direction", F.when(F.col("event_type") == td.EXIT_EVENT_TYPE, F.lit(SUBWAY_EXIT_LABEL)).otherwise(F.lit("승차"))
    )
    per = located.select("date", "area_name", "direction", "hour", F.lit(1).cast("long").alias("n"))
    wide = rows_to_columns(per, ["date", "area_name", "direction"], "hour", "n", NIGHT_HOURS, "h{key:02d}")

    def feed(layout_hours, date_fmt, line_col, reverse):
        cols = [
            F.date_format("date", date_fmt).alias(SUBWAY_DATE),
            F.lit("line").alias(line_col),
            F.concat(F.lit(" "), F.col("area_name"), F.lit(" ")).alias(SUBWAY_STATION),
            F.concat(F.lit(" "), F.col("direction")).alias(SUBWAY_DIRECTION),
            F.lit("일반").alias(SUBWAY_PASSENGER_TYPE),
            *[F.format_number(F.col(f"h{h:02d}"), 0).alias(name) for h, name in layout_hours],
        ]
        return wide.select(*(cols[::-1] if reverse else cols))

    base = staging_path(spark, "ridership-feed")
    wide.write.parquet(f"{base}/wide")
    wide = spark.read.parquet(f"{base}/wide")
    first_half = F.dayofmonth("date") <= 15
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    a, b = feed(_layout_a_hours(), "yyyy-MM-dd", "호선명", False), feed(_layout_b_hours(), "yyyy.MM.dd", "호선", True)
    a.filter(first_half).write.options(**keep).csv(f"{base}/a")
    b.filter(~first_half).write.options(encoding="CP949", **keep).csv(f"{base}/b")
    return [CsvLayout(f"{base}/a", "UTF-8"), CsvLayout(f"{base}/b", "CP949")]


def _paths(layouts: list[CsvLayout]) -> list[str]:
    return [x.path for x in layouts]


def _ridership_fact_from_feed(spark, sf, paths, encoding="auto"):
    obs = read_csv_layouts(spark, paths, encoding, per_layout=subway_observations)
    areas = td.area_of_nation(spark, sf)
    units = areas.select(F.col("area_name").alias("raw_station_name"), "area_id", "area_name", "area_type")
    return ridership_fact(obs, units, td.event_calendar(spark), unit_col="raw_station_name")


def ridership_from_wide_csv(spark, sf):
    """The two-layout, two-charset feed read back by its stated layouts, in one strict
    pass; equals ``fact_ridership``."""
    return _ridership_fact_from_feed(spark, sf, _write_ridership_feed(spark, sf))


def ridership_from_normalized_csv(spark, sf):
    """The same feed first rewritten as UTF-8 per layout (S8), then read with an
    explicit UTF-8 charset; equals ``fact_ridership``."""
    folders = normalize_to_utf8(spark, _paths(_write_ridership_feed(spark, sf)), staging_path(spark, "ridership-utf8"))
    return _ridership_fact_from_feed(spark, sf, [CsvLayout(f, "UTF-8") for f in folders])


def _ridership_by_manifest(spark, sf):
    """(feed folders, manifest) after two loads: the second one profiles only the folder that is new."""
    folders = _paths(_write_ridership_feed(spark, sf))
    manifest = staging_path(spark, "manifest")
    for landed in (folders[:1], folders):
        update_manifest(spark, landed, manifest)
    return folders, manifest


def ridership_from_manifest_csv(spark, sf):
    """The feed read through a layout manifest: both layouts and charsets in one pass over the bytes; equals ``fact_ridership``."""
    folders, manifest = _ridership_by_manifest(spark, sf)
    obs = subway_observations(read_csv_manifest(spark, folders, manifest, SUBWAY_WANTED, SUBWAY_OPTIONAL))
    units = td.area_of_nation(spark, sf).select(F.col("area_name").alias("raw_station_name"), "area_id", "area_name", "area_type")
    return ridership_fact(obs, units, td.event_calendar(spark), unit_col="raw_station_name")


def csv_manifest_layouts(spark, sf):
    """Rows of the feed per charset and header layout, as the manifest of two loads knows them."""
    folders, manifest = _ridership_by_manifest(spark, sf)
    known = read_manifest(spark, manifest).select("path", "charset", F.split_part("header", F.lit(","), F.lit(1)).alias("first_column"))
    rows = spark.read.option("header", True).csv(folders).select(F.col("_metadata.file_path").alias("path"))
    return rows.join(known, "path").groupBy("charset", "first_column").agg(F.count(F.lit(1)).alias("data_rows"))


def csv_detect_encoding(spark, sf):
    """Charset detected per file of the two-charset feed (S8), as data rows per
    detected charset (file names and counts depend on the writer, rows do not)."""
    by_charset: dict[str, list[str]] = {}
    for path, charset in detect_encodings(spark, _paths(_write_ridership_feed(spark, sf))).items():
        by_charset.setdefault(charset, []).append(path)
    frames = [
        read_csv_strings(spark, sorted(paths), charset).select(F.lit(charset).alias("charset"))
        for charset, paths in sorted(by_charset.items())
    ]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    return rows.groupBy("charset").agg(F.count(F.lit(1)).alias("data_rows"))


def _mapping_csv(spark, sf) -> DataFrame:
    """The area mapping as a CSV of customers (unit: segment, station: customer name within blanks),
    written and read back: one row per customer, many per (area, unit)."""
    c = td.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_mktsegment", "c_name")
    rows = join_dimension(c, td.area_of_nation(spark, sf), "nationkey").select(
        "area_id", "area_name", "area_type", F.col("c_mktsegment").alias("dong_code"),
        F.lower("c_mktsegment").alias("dong_name"),
        F.concat(F.lit(" "), F.substring("c_name", 1, 17), F.lit("  ")).alias("station_name"),
        F.lit("line").alias("line_name"), F.lit(None).cast("string").alias("notes"),
    )
    path = staging_path(spark, "area-mapping")
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_small_csv(spark, path)


def dedupe_dimension(spark, sf):
    """(area, unit) rows of an area mapping read from CSV."""
    return units_to_areas(_mapping_csv(spark, sf))


def station_dimension(spark, sf):
    """(area, station) rows of an area mapping read from CSV."""
    return stations_to_areas(_mapping_csv(spark, sf))


def station_area_chain(spark, sf):
    """Feed name -> station -> area (J2, J3) with a given name table: every customer under
    a feed name; names of every seventh customer lead to no station."""
    c = td.table(spark, sf, "customer").select("c_custkey", F.substring("c_name", 1, 17).alias("name"))
    names = c.select(
        F.concat(F.lit("feed-"), F.col("c_custkey").cast("string")).alias("raw_station_name"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("name")).otherwise(F.lit("nowhere")).alias("station_name"),
    )
    return station_units(spark, _mapping_csv(spark, sf), names)


def typed_calendar(spark, sf):
    """A calendar CSV (S4) of the orders' weeks, some with numbers like 1.0 and some that don't parse."""
    o = td.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_orderpriority", "o_orderstatus")
    odd = F.col("o_orderkey") % 5 == 0
    rows = o.select(
        F.concat(F.year("d").cast("string"), F.when(odd, ".0").otherwise("")).alias("year"),
        F.when(F.col("o_orderkey") % 11 == 0, "first").otherwise(F.when(F.month("d") <= 6, "1").otherwise(" 2 ")).alias("semester"),
        F.col("o_orderpriority").alias("exam_type"), F.col("o_orderstatus").alias("phase"),
        F.when(F.col("o_orderkey") % 13 == 0, "2024-02-31").otherwise(F.date_format("d", "yyyy-MM-dd")).alias("start_date"),
        F.date_format(F.date_add("d", 6), "yyyy-MM-dd").alias("end_date"), F.lit("").alias("notes"),
    )
    path = staging_path(spark, "calendar")
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return typed_periods(read_small_csv(spark, path))


def literal_dimension_join(spark, sf):
    """The unit map built with joins only: customer -> nation -> region -> literal
    (region name -> area type) table (S5, J2); one row per customer."""
    schema = T.StructType([T.StructField("r_name", T.StringType()), T.StructField("area_type", T.StringType())])
    types = local_table(spark, td.REGION_AREA_TYPES, schema)
    region = join_dimension(td.table(spark, sf, "region"), types, "r_name", "left", literal=True)
    region = region.select(F.col("r_regionkey").alias("n_regionkey"), "area_type")
    nation = join_dimension(td.table(spark, sf, "nation"), region, "n_regionkey").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").cast("string").alias("area_id"),
        F.col("n_name").alias("area_name"), "area_type",
    )
    customer = td.table(spark, sf, "customer").select(F.col("c_custkey").alias("unit_code"), "c_nationkey")
    return join_dimension(customer, nation, "c_nationkey").select("unit_code", "area_id", "area_name", "area_type")


# ---------------------------------------------------------------------------
# Sinks, tables, top-k, gates
# ---------------------------------------------------------------------------

R1_EXPORT_SCHEMA = T.StructType(
    [
        T.StructField("semester", T.IntegerType()),
        T.StructField("exam_type", T.StringType()),
        T.StructField("area_id", T.StringType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("area_type", T.StringType()),
        T.StructField("before_population", T.DoubleType()),
        T.StructField("during_population", T.DoubleType()),
        T.StructField("after_population", T.DoubleType()),
        T.StructField("during_lift", T.DoubleType()),
        T.StructField("after_lift", T.DoubleType()),
    ]
)


def ordered_export_roundtrip(spark, sf):
    pop, rid = event_facts(spark, sf)
    path = staging_path(spark, "export-r1")
    r1 = REPORTS["population_phase_change"].build(pop, rid, scales=td.MEASURE_SCALES)
    export_report(rounded(r1), "population_phase_change", path)
    return spark.read.schema(R1_EXPORT_SCHEMA).options(**EXPORT_FORMAT).csv(path)


def ordered_export_positions(spark, sf):
    """The customers exported in a total order (O1) over several part files: each line's
    place in the export, counted through the files in name order."""
    path = staging_path(spark, "export-order")
    c = td.table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    export_delimited(c.repartition(4), path, ["c_mktsegment", "c_nationkey", "c_custkey"])
    # a line's number within its file needs no order of files: it grows along a file
    lines = spark.read.schema("c_mktsegment string, c_nationkey int, c_custkey long").options(**EXPORT_FORMAT).csv(path).select(
        "*", F.col("_metadata.file_path").alias("f"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("n")
    )
    base = staging_path(spark, "export-lines")
    lines.write.parquet(base)
    lines = spark.read.parquet(base)
    before = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)  # one row per part file
    starts = lines.groupBy("f").count().select("f", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("f").orderBy("n")) + F.col("start")
    return lines.join(starts, "f").select(place.cast("long").alias("position"), "c_mktsegment", "c_nationkey", "c_custkey")


def export_text_cells(spark, sf):
    """The lines of an export (K3) of text cells with blanks, commas, quotes, backslashes, empty and NULL."""
    c = td.table(spark, sf, "customer")
    k = F.col("c_custkey")
    cell = (
        F.when(k % 6 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .when(k % 6 == 1, F.concat_ws(", ", "c_name", "c_mktsegment"))
        .when(k % 6 == 2, F.concat(F.lit('a "'), F.col("c_name"), F.lit('" b')))
        .when(k % 6 == 3, F.lit(""))
        .when(k % 6 == 4, F.concat(F.lit("x\\"), F.col("c_name")))
    )
    path = staging_path(spark, "export-text")
    export_delimited(c.select("c_custkey", cell.alias("label"), "c_mktsegment"), path, ["c_custkey"])
    return spark.read.text(path).withColumnRenamed("value", "line")


def save_table_roundtrip(spark, sf):
    """Drop-and-create table as select (K2): saved twice under one name, read back; then dropped
    and saved again as the customers of one more column."""
    base = staging_path(spark, "saved")
    db = "periodlens_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{base}'")
    name = f"`{db}`.`result_customers`"
    c = td.table(spark, sf, "customer")
    save_table(c.select("c_custkey"), name)
    drop_table(spark, name)
    save_table(c.select("c_custkey", "c_name"), name)
    save_table(c.select("c_custkey", "c_nationkey", "c_mktsegment"), name)
    return spark.table(name)


def existence_probes(spark, sf):
    """Whether any order (O2) of each status and priority is above a price."""
    o = td.table(spark, sf, "orders")
    cases = [(s, x) for s in ("F", "O", "P", "Q") for x in (0, 400_000, 10_000_000)]
    probes = [existence(o.filter((F.col("o_orderstatus") == s) & (F.col("o_totalprice") > x)), f"{s}>{x}") for s, x in cases]
    return reduce(lambda a, b: a.unionAll(b), probes)


def table_roundtrip(spark, sf):
    pop, rid = event_facts(spark, sf)
    base = staging_path(spark, "tables")
    write_parquet(pop, f"{base}/area_population", partition_by=("year", "month"))
    write_parquet(rid, f"{base}/area_subway")
    db = "periodlens_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{base}/warehouse'")
    create_database(spark, db)
    register_fact_table(spark, db, "area_population", f"{base}/area_population")
    register_fact_table(spark, db, "area_subway", f"{base}/area_subway")
    pop_t, rid_t = spark.table(f"{db}.area_population"), spark.table(f"{db}.area_subway")
    return rounded(area_type_change(pop_t, rid_t, scales=td.MEASURE_SCALES))


def top_k_lift(spark, sf, k: int = 20):
    pop, _ = event_facts(spark, sf)
    r2 = rounded(young_population_lift(pop, None, scales=td.MEASURE_SCALES))
    return r2.orderBy(F.col("young_after_lift").desc_nulls_last(), "semester", "exam_type", "area_id").limit(k)


def nonempty_counts(spark, sf):
    """Rows that pass each gate (Q1) of a ridership build: parsed, at night, with a known unit, with
    an area. The unit map knows all customers but those of every ninth key, and gives no area to every
    fifth."""
    known = td.unit_areas(spark, sf).filter(F.col("unit_code") % 9 != 0)
    units = known.withColumn("area_id", F.when(F.col("unit_code") % 5 != 0, F.col("area_id")))
    gates = Gates("catalog")
    obs = gates.watch(td.exit_observations(spark, sf), "feed parsing")
    fact = ridership_fact(obs, units, td.event_calendar(spark), gates=gates)
    fact.write.format("noop").mode("overwrite").save()
    # four numbers, counted by the job itself
    return spark.createDataFrame(list(gates.check().items()), "stage string, row_count long")


# ---------------------------------------------------------------------------
# ---------------------------------------------------------------------------


def row_number_two_orders(spark, sf):
    """Two row numbers over the same partition with different orders (W2, P13):
    each customer's orders by price and by date, a hot customer's over several tasks."""
    o = td.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("order_date")
    )
    by_price = ranked(o, ["o_custkey"], "o_totalprice", "price_rank", ("o_orderkey",), method="range")
    both = ranked(by_price, ["o_custkey"], "order_date", "recency_rank", ("o_orderkey",), method="range")
    return both.select(
        "o_custkey", "o_orderkey", "price_rank", "recency_rank",
        (F.col("price_rank") - F.col("recency_rank")).alias("rank_gap"),
    )


def row_number_three_keys(spark, sf):
    """Row numbers within (nation, segment) by balance, numbered with the
    distributed range method (W3 on a frame that grows with the data)."""
    c = td.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return ranked(c, ["c_nationkey", "c_mktsegment"], "c_acctbal", "balance_rank", ("c_custkey",), method="range")


def row_number_all_columns(spark, sf):
    """The orders with all their columns, ranked by price within few large groups."""
    o = td.table(spark, sf, "orders")
    return rounded(ranked(o, ["o_orderstatus"], "o_totalprice", "price_rank", ("o_orderkey",), method="range"))


def row_number_null_group(spark, sf):
    """Ranks within groups of which one is NULL, and with NULLs among the ranked values."""
    c = td.table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("balance"),
    )
    return ranked(c, ["segment"], "balance", "balance_rank", ("c_custkey",), method="range")


def phase_avg_pivot(spark, sf):
    """Three-phase pivot of the total by (exam type, time band) (A3)."""
    pop, _ = event_facts(spark, sf)
    avgs = phase_avg(
        pop,
        ["exam_type", "time_band"],
        [(f"{p}_population", "total_population", p) for p in ("before", "during", "after")],
        scales=td.MEASURE_SCALES,
    )
    return rounded(avgs)


def group_phase_avg_query(spark, sf):
    """Group x phase pivot with three single-type groups."""
    pop, _ = event_facts(spark, sf)
    groups = {"univ": ["university"], "culture": ["culture_university"], "night": ["nightlife"]}
    scale = td.MEASURE_SCALES["total_population"]
    return rounded(group_phase_avg(pop, ["semester", "exam_type"], "total_population", groups, scale=scale))


def guarded_ratio_query(spark, sf):
    """Young share of each area's daily total, NULL when the total is not positive."""
    pop, _ = event_facts(spark, sf)
    daily = pop.groupBy("date", "area_id").agg(
        F.sum(to_units("young_20s_population", td.VALUE_SCALE)).alias("young"),
        F.sum(to_units("total_population", td.VALUE_SCALE)).alias("total"),
    )
    return rounded(daily.select("date", "area_id", guarded_ratio("young", "total").alias("young_share")))


def resolve_columns_two_layouts(spark, sf):
    """Exit observations of the two-layout, two-charset feed, before any mapping
    (P3, U1, Q2): layouts and charsets detected per file, each resolved against its own header."""
    obs = read_csv_layouts(spark, _paths(_write_ridership_feed(spark, sf)), per_layout=subway_observations)
    return obs.select("date", "hour", "raw_station_name", "alighting_count")


def _people_feed(spark, sf, encoding: str):
    ev = _events_dated(spark, sf)
    per = ev.groupBy("date", "hour", "user_id").agg(
        F.sum(F.rint(F.col("value") * 100).cast("long")).alias("tot"),
        F.sum(F.when(F.col("event_type") == "view", F.rint(F.col("value") * 100).cast("long"))).alias("v"),
    )
    text = lambda c: F.format_string("%.2f", F.col(c) / 100.0)
    feed = per.select(
        F.date_format("date", "yyyyMMdd").alias("\ufeff" + PEOPLE_DATE if encoding == "UTF-8" else PEOPLE_DATE),
        F.col("hour").cast("string").alias(PEOPLE_HOUR),
        F.col("user_id").cast("string").alias(PEOPLE_UNIT),
        text("tot").alias(PEOPLE_TOTAL),
        text("v").alias(PEOPLE_YOUNG[0]),
        F.lit("").alias(PEOPLE_YOUNG[1]),
        F.lit("-").alias(PEOPLE_YOUNG[2]),
        F.lit(None).cast("string").alias(PEOPLE_YOUNG[3]),
    )
    path = staging_path(spark, f"people-{encoding.lower()}")
    feed.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)
    return path


def _people_obs(spark, path, encoding, single_layout):
    obs = read_csv_layouts(spark, path, encoding, per_layout=people_observations, single_layout=single_layout)
    return rounded(obs.select(
        "date", "hour", F.col("unit_code").cast("long").alias("unit_code"), "total_population", "young_20s_population"
    ))


def csv_roundtrip_utf8_bom(spark, sf):
    """Population feed in UTF-8 with a BOM in the header, charset detected."""
    return _people_obs(spark, _people_feed(spark, sf, "UTF-8"), "auto", False)


def csv_roundtrip_cp949(spark, sf):
    """Population feed in CP949, read with an explicit charset in one pass."""
    return _people_obs(spark, _people_feed(spark, sf, "CP949"), "CP949", True)


QUERIES = {
    "rejected_rows_by_reason": rejected_rows_by_reason,
    "top_orders_per_segment": top_orders_per_segment,
    "partitioned_table_roundtrip": partitioned_table_roundtrip,
    "calendar_overlap_days": calendar_overlap_days,
    "fact_population_incremental": fact_population_incremental,
    "label_periods_expanded": label_periods_expanded,
    "label_periods_range": label_periods_range,
    "label_periods_overlap": label_periods_overlap,
    "calendar_overlap_check": calendar_overlap_check,
    "time_bands": time_bands,
    "date_parts": date_parts_query,
    "parse_thousands": parse_thousands,
    "parse_dates_lenient": parse_dates_lenient,
    "safe_row_sum": safe_row_sum_query,
    "lift_null_base": lift_null_base,
    "late_night_previous_day": late_night_previous_day,
    "pooled_by_exam": pooled_by_exam,
    "pooled_by_exam_year": pooled_by_exam_year,
    "rank_compare_by_exam_year": rank_compare_by_exam_year,
    "did_exits_by_exam_year": did_exits_by_exam_year,
    "unpivot_hours": unpivot_hours,
    "population_from_csv": population_from_csv,
    "ridership_from_wide_csv": ridership_from_wide_csv,
    "ridership_from_normalized_csv": ridership_from_normalized_csv,
    "ridership_from_manifest_csv": ridership_from_manifest_csv,
    "csv_manifest_layouts": csv_manifest_layouts,
    "csv_detect_encoding": csv_detect_encoding,
    "dedupe_dimension": dedupe_dimension,
    "station_dimension": station_dimension,
    "station_area_chain": station_area_chain,
    "typed_calendar": typed_calendar,
    "literal_dimension_join": literal_dimension_join,
    "ordered_export_roundtrip": ordered_export_roundtrip,
    "ordered_export_positions": ordered_export_positions,
    "export_text_cells": export_text_cells,
    "table_roundtrip": table_roundtrip,
    "save_table_roundtrip": save_table_roundtrip,
    "existence_probes": existence_probes,
    "top_k_lift": top_k_lift,
    "nonempty_counts": nonempty_counts,
    "row_number_two_orders": row_number_two_orders,
    "row_number_three_keys": row_number_three_keys,
    "row_number_all_columns": row_number_all_columns,
    "row_number_null_group": row_number_null_group,
    "phase_avg_pivot": phase_avg_pivot,
    "group_phase_avg": group_phase_avg_query,
    "guarded_ratio": guarded_ratio_query,
    "resolve_columns_two_layouts": resolve_columns_two_layouts,
    "csv_roundtrip_utf8_bom": csv_roundtrip_utf8_bom,
    "csv_roundtrip_cp949": csv_roundtrip_cp949,
}


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

_LABEL_SQL = """WITH {cal}
SELECT e.event_id, CAST(e.ts AS DATE) AS date, c.exam_year, c.semester,
  COALESCE(c.exam_type, 'normal') AS exam_type, COALESCE(c.phase, 'normal') AS phase
FROM events e LEFT JOIN cal c ON CAST(e.ts AS DATE) BETWEEN c.start_date AND c.end_date"""

_OVERLAP_CAL = SQL_CALENDAR.rstrip(")") + """),
  (2024, 1, 'festival', 'during', DATE '2024-01-10', DATE '2024-01-14'))"""

_ORDER_CAL = """
ocal(exam_year, semester, exam_type, phase, start_date, end_date) AS (VALUES
  (1996, 1, 'midterm', 'before', DATE '1996-04-01', DATE '1996-04-14'),
  (1996, 1, 'midterm', 'after',  DATE '1996-04-22', DATE '1996-05-05'),
  (1997, 1, 'midterm', 'before', DATE '1997-04-01', DATE '1997-04-14'),
  (1997, 1, 'midterm', 'after',  DATE '1997-04-22', DATE '1997-05-05'))"""


def _order_r1_sql(by_year: bool) -> str:
    y = ", exam_year" if by_year else ""
    cy = ", c.exam_year" if by_year else ""
    return f"""WITH {_ORDER_CAL},{SQL_UNITS},
f AS (
  SELECT c.semester, COALESCE(c.exam_type, 'normal') AS exam_type{cy}, u.area_id, u.area_name, u.area_type,
    COALESCE(c.phase, 'normal') AS phase, CAST(o.o_orderdate AS DATE) AS d,
    o.o_orderkey % 24 AS h,
    CAST(SUM(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS tot
  FROM orders o JOIN units u ON o.o_custkey = u.unit_code
  LEFT JOIN ocal c ON CAST(o.o_orderdate AS DATE) BETWEEN c.start_date AND c.end_date
  WHERE o.o_orderkey % 24 >= 18 OR o.o_orderkey % 24 <= 2
  GROUP BY ALL),
s AS (
  SELECT semester, exam_type{y}, area_id, area_name, area_type,
    {_xavg("tot", "phase = 'before'")} AS b,
    {_xavg("tot", "phase = 'during'")} AS du,
    {_xavg("tot", "phase = 'after'")} AS a
  FROM f WHERE phase IN ('before', 'during', 'after') AND semester IS NOT NULL
  GROUP BY semester, exam_type{y}, area_id, area_name, area_type)
SELECT semester, exam_type{y}, area_id, area_name, area_type, ROUND(b, 6) AS before_population,
  ROUND(du, 6) AS during_population, ROUND(a, 6) AS after_population,
  ROUND(CASE WHEN b > 0 THEN (du - b) / b END, 6) AS during_lift,
  ROUND(CASE WHEN b > 0 THEN (a - b) / b END, 6) AS after_lift
FROM s"""


SQL_FACTS_PREFIX = SQL_FACTS

_PEOPLE_OBS_SQL = """SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, user_id AS unit_code,
  ROUND(CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / 100.0, 6) AS total_population,
  ROUND(COALESCE(CAST(SUM(CASE WHEN event_type = 'view' THEN CAST(ROUND(value * 100) AS BIGINT) END) AS DOUBLE)
    / 100.0, 0), 6) AS young_20s_population
FROM events GROUP BY ALL"""


ORACLE_SQL = {
    "label_periods_expanded": _LABEL_SQL.format(cal=SQL_CALENDAR),
    "label_periods_range": _LABEL_SQL.format(cal=SQL_CALENDAR),
    "label_periods_overlap": _LABEL_SQL.format(cal=_OVERLAP_CAL),
    "calendar_overlap_check": """WITH p AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS exam_year,
    CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester,
    o_orderpriority AS exam_type, o_orderstatus AS phase,
    CAST(o_orderdate AS DATE) AS start_date, CAST(CAST(o_orderdate AS DATE) + 6 AS DATE) AS end_date
  FROM orders WHERE o_orderdate IS NOT NULL),
d AS (SELECT p.*, CAST(p.start_date + CAST(g.i AS INTEGER) AS DATE) AS day FROM p, range(0, 7) AS g(i)),
k AS (SELECT day, COUNT(*) AS n FROM d GROUP BY day)
SELECT d.exam_year, d.semester, d.exam_type, d.phase, d.start_date, d.end_date,
  COUNT(DISTINCT d.day) AS period_days,
  COUNT(DISTINCT CASE WHEN k.n > 1 THEN d.day END) AS overlap_days,
  COUNT(DISTINCT CASE WHEN k.n > 1 THEN d.day END) > 0 AS is_overlapping
FROM d JOIN k ON d.day = k.day
GROUP BY d.exam_year, d.semester, d.exam_type, d.phase, d.start_date, d.end_date""",
    "time_bands": """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
  CASE WHEN hour(ts) >= 18 AND hour(ts) < 21 THEN 'evening' WHEN hour(ts) >= 21 AND hour(ts) < 24 THEN 'night'
       WHEN hour(ts) >= 0 AND hour(ts) <= 2 THEN 'late_night' ELSE 'other' END AS time_band,
  (hour(ts) >= 18 AND hour(ts) < 24) OR (hour(ts) >= 0 AND hour(ts) <= 2) AS is_night
FROM events""",
    "date_parts": """SELECT event_id, CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year,
  CAST(month(ts) AS INTEGER) AS month, strftime(ts, '%a') AS day_of_week,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week_num, dayofweek(ts) IN (0, 6) AS is_weekend
FROM events""",
    "parse_thousands": "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders",
    "parse_dates_lenient": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  CAST(try_strptime(strftime(o_orderdate, '%Y%m') || '31', '%Y%m%d') AS DATE) AS month_day_31
FROM orders WHERE o_orderdate IS NOT NULL""",
    "safe_row_sum": """SELECT o_orderkey,
  ROUND(COALESCE(o_totalprice, 0) + 0 + COALESCE(CAST(o_custkey AS DOUBLE), 0), 6) AS row_sum FROM orders""",
    "lift_null_base": """WITH p AS (
  SELECT o_custkey,
    CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) ELSE 0 END) AS DOUBLE) / 100.0 AS base,
    CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) ELSE 0 END) AS DOUBLE) / 100.0 AS new
  FROM orders GROUP BY o_custkey)
SELECT o_custkey, ROUND(base, 6) AS base, ROUND(new, 6) AS new,
  ROUND(CASE WHEN base > 0 THEN (new - base) / base END, 6) AS lift,
  ROUND(CASE WHEN base > 0 THEN new / base END, 6) AS ratio
FROM p""",
    "late_night_previous_day": f"""WITH {SQL_CALENDAR},{SQL_UNITS},{sql_population(
        "CASE WHEN hour(ts) <= 2 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END", "lpop")}
SELECT date, year, month, day_of_week, day_of_week_num, is_weekend, hour, time_band, area_id, area_name,
  area_type, phase, exam_type, semester, ROUND(total_population, 6) AS total_population,
  ROUND(young_20s_population, 6) AS young_20s_population, ROUND(young_20s_ratio, 6) AS young_20s_ratio
FROM lpop""",
    "pooled_by_exam": _order_r1_sql(False),
    "pooled_by_exam_year": _order_r1_sql(True),
    "rank_compare_by_exam_year": f"""WITH {_ORDER_CAL},{SQL_UNITS},
f AS (
  SELECT c.semester, c.exam_type, c.exam_year, u.area_id, u.area_name, u.area_type, c.phase,
    CAST(o.o_orderdate AS DATE) AS d, o.o_orderkey % 24 AS h,
    CAST(SUM(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS tot,
    COUNT(*) AS n
  FROM orders o JOIN units u ON o.o_custkey = u.unit_code
  JOIN ocal c ON CAST(o.o_orderdate AS DATE) BETWEEN c.start_date AND c.end_date
  WHERE o.o_orderkey % 24 >= 18 OR o.o_orderkey % 24 <= 2
  GROUP BY ALL),
p AS (
  SELECT semester, exam_type, exam_year, area_id, area_name, area_type, {_xavg("tot")} AS ap
  FROM f WHERE phase = 'after' AND semester IS NOT NULL
  GROUP BY semester, exam_type, exam_year, area_id, area_name, area_type),
r AS (
  SELECT semester, exam_type, exam_year, area_id, AVG(n) AS aa
  FROM f WHERE phase = 'after' AND semester IS NOT NULL
  GROUP BY semester, exam_type, exam_year, area_id),
j AS (
  SELECT p.*, r.aa,
    ROW_NUMBER() OVER (PARTITION BY p.semester, p.exam_type, p.exam_year ORDER BY p.ap DESC NULLS LAST, p.area_id) AS population_rank,
    ROW_NUMBER() OVER (PARTITION BY p.semester, p.exam_type, p.exam_year ORDER BY r.aa DESC NULLS LAST, p.area_id) AS subway_rank
  FROM p JOIN r ON p.semester = r.semester AND p.exam_type = r.exam_type AND p.exam_year = r.exam_year
    AND p.area_id = r.area_id)
SELECT semester, exam_type, exam_year, area_id, area_name, area_type, ROUND(ap, 6) AS after_population,
  ROUND(aa, 6) AS after_alighting, population_rank, subway_rank, population_rank - subway_rank AS rank_gap
FROM j""",
    "did_exits_by_exam_year": f"""WITH {_ORDER_CAL},{SQL_UNITS},
f AS (
  SELECT c.semester, c.exam_type, c.exam_year, u.area_type, c.phase, CAST(o.o_orderdate AS DATE) AS d,
    u.area_id, u.area_name, o.o_orderkey % 24 AS h, COUNT(*) AS n
  FROM orders o JOIN units u ON o.o_custkey = u.unit_code
  JOIN ocal c ON CAST(o.o_orderdate AS DATE) BETWEEN c.start_date AND c.end_date
  WHERE o.o_orderkey % 24 >= 18 OR o.o_orderkey % 24 <= 2
  GROUP BY ALL),
g AS (
  SELECT semester, exam_type, exam_year,
    AVG(CASE WHEN area_type IN ('university', 'culture_university', 'university_nightlife') AND phase = 'before' THEN n END) AS tb,
    AVG(CASE WHEN area_type IN ('university', 'culture_university', 'university_nightlife') AND phase = 'after' THEN n END) AS ta,
    AVG(CASE WHEN area_type IN ('nightlife', 'nightlife_business') AND phase = 'before' THEN n END) AS cb,
    AVG(CASE WHEN area_type IN ('nightlife', 'nightlife_business') AND phase = 'after' THEN n END) AS ca
  FROM f WHERE phase IN ('before', 'after') AND semester IS NOT NULL
    AND area_type IN ('university', 'culture_university', 'university_nightlife', 'nightlife', 'nightlife_business')
  GROUP BY semester, exam_type, exam_year)
SELECT semester, exam_type, exam_year, ROUND(tb, 6) AS treatment_before_alighting, ROUND(ta, 6) AS treatment_after_alighting,
  ROUND(CASE WHEN tb > 0 THEN (ta - tb) / tb END, 6) AS treatment_lift,
  ROUND(cb, 6) AS control_before_alighting, ROUND(ca, 6) AS control_after_alighting,
  ROUND(CASE WHEN cb > 0 THEN (ca - cb) / cb END, 6) AS control_lift,
  ROUND(CASE WHEN tb > 0 AND cb > 0 THEN (ta - tb) / tb - (ca - cb) / cb END, 6) AS did_lift
FROM g""",
    "unpivot_hours": """SELECT CAST(ts AS DATE) AS date, user_id AS unit_code, CAST(hour(ts) AS INTEGER) AS hour,
  COUNT(*) AS events
FROM events WHERE hour(ts) >= 18 OR hour(ts) <= 2 GROUP BY ALL""",
    "population_from_csv": REPORT_SQL["fact_population"],
    "ridership_from_wide_csv": REPORT_SQL["fact_ridership"],
    "ridership_from_normalized_csv": REPORT_SQL["fact_ridership"],
    "ridership_from_manifest_csv": REPORT_SQL["fact_ridership"],
    "fact_population_incremental": REPORT_SQL["fact_population"],
    "partitioned_table_roundtrip": REPORT_SQL["fact_population"],
    "rejected_rows_by_reason": """WITH e AS (SELECT hour(ts) AS h, event_type = 'purchase' AS hit FROM events),
r AS (SELECT CASE WHEN NOT hit THEN 'accepted' WHEN h = 2 THEN 'no date' WHEN h IN (0, 1) THEN 'bad date' WHEN h = 5 THEN 'no hour'
  WHEN h IN (3, 4) THEN 'bad hour' WHEN h IN (6, 7) THEN 'no unit' WHEN h IN (8, 9) THEN 'bad total' ELSE 'accepted' END AS reason FROM e)
SELECT reason, COUNT(*) AS n_rows FROM r GROUP BY reason""",
    "top_orders_per_segment": """SELECT c_mktsegment, rank_no, o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice FROM (
  SELECT c.c_mktsegment, o.o_orderkey, o.o_totalprice, ROW_NUMBER() OVER (PARTITION BY c.c_mktsegment ORDER BY o.o_totalprice DESC, o.o_orderkey) AS rank_no
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) WHERE rank_no <= 25""",
    "csv_manifest_layouts": """WITH w AS (
  SELECT DISTINCT CAST(e.ts AS DATE) AS d, n.n_name, e.event_type = 'purchase' AS leaving
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE hour(e.ts) >= 18 OR hour(e.ts) <= 2)
SELECT 'UTF-8' AS charset, '수송일자' AS first_column, COUNT(*) AS data_rows FROM w WHERE day(d) <= 15 HAVING COUNT(*) > 0
UNION ALL SELECT 'CP949', '02시', COUNT(*) FROM w WHERE day(d) > 15 HAVING COUNT(*) > 0""",
    "csv_detect_encoding": """WITH w AS (
  SELECT DISTINCT CAST(e.ts AS DATE) AS d, n.n_name,
    CASE WHEN e.event_type = 'purchase' THEN 'exit' ELSE 'entry' END AS direction
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE hour(e.ts) >= 18 OR hour(e.ts) <= 2)
SELECT CASE WHEN day(d) <= 15 THEN 'UTF-8' ELSE 'CP949' END AS charset, COUNT(*) AS data_rows
FROM w GROUP BY 1""",
    "dedupe_dimension": f"""WITH {SQL_UNITS}
SELECT DISTINCT u.area_id, u.area_name, u.area_type, c.c_mktsegment AS unit_code
FROM customer c JOIN units u ON c.c_custkey = u.unit_code""",
    "station_dimension": f"""WITH {SQL_UNITS}
SELECT DISTINCT u.area_id, u.area_name, u.area_type, TRIM(SUBSTRING(c.c_name, 1, 17)) AS station_name
FROM customer c JOIN units u ON c.c_custkey = u.unit_code""",
    "station_area_chain": f"""WITH {SQL_UNITS},
st AS (
  SELECT DISTINCT u.area_id, u.area_name, u.area_type, TRIM(SUBSTRING(c.c_name, 1, 17)) AS station_name
  FROM customer c JOIN units u ON c.c_custkey = u.unit_code),
nm AS (
  SELECT 'feed-' || CAST(c_custkey AS VARCHAR) AS raw_station_name,
    CASE WHEN c_custkey % 7 <> 0 THEN SUBSTRING(c_name, 1, 17) ELSE 'nowhere' END AS station_name
  FROM customer)
SELECT nm.station_name, nm.raw_station_name, st.area_id, st.area_name, st.area_type
FROM nm LEFT JOIN st ON nm.station_name = st.station_name""",
    "typed_calendar": """SELECT CAST(year(o_orderdate) AS INTEGER) AS exam_year,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester,
  o_orderpriority AS exam_type, o_orderstatus AS phase,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date,
  CAST(CAST(o_orderdate AS DATE) + 6 AS DATE) AS end_date
FROM orders""",
    "literal_dimension_join": f"""WITH {SQL_UNITS}
SELECT unit_code, area_id, area_name, area_type FROM units""",
    "ordered_export_roundtrip": REPORT_SQL["report_population_phase_change"],
    "ordered_export_positions": """SELECT
  ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) AS position, c_mktsegment, c_nationkey, c_custkey
FROM customer""",
    "export_text_cells": """SELECT CAST(c_custkey AS VARCHAR) || ',' || CASE c_custkey % 6
    WHEN 0 THEN '  ' || c_name || ' ' WHEN 1 THEN '"' || c_name || ', ' || c_mktsegment || '"'
    WHEN 2 THEN '"a ""' || c_name || '"" b"' WHEN 3 THEN '' WHEN 4 THEN 'x\\' || c_name ELSE '\\N' END || ',' || c_mktsegment AS line
FROM customer""",
    "save_table_roundtrip": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "existence_probes": """SELECT s || '>' || CAST(x AS VARCHAR) AS label,
  EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = s AND o_totalprice > x) AS present
FROM (VALUES ('F'), ('O'), ('P'), ('Q')) a(s), (VALUES (0), (400000), (10000000)) b(x)""",
    "table_roundtrip": REPORT_SQL["report_area_type_change"],
    "top_k_lift": f"""SELECT * FROM ({REPORT_SQL['report_young_population_lift']}) r2
ORDER BY young_after_lift DESC NULLS LAST, semester, exam_type, area_id LIMIT 20""",
    "row_number_two_orders": """SELECT o_custkey, o_orderkey, price_rank, recency_rank, price_rank - recency_rank AS rank_gap
FROM (SELECT o_custkey, o_orderkey,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS price_rank,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey)
      AS recency_rank
  FROM orders) x""",
    "row_number_three_keys": """SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
  ROW_NUMBER() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC NULLS LAST, c_custkey)
    AS balance_rank
FROM customer""",
    "row_number_all_columns": """SELECT *,
  ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS price_rank
FROM orders""",
    "row_number_null_group": """SELECT c_custkey, c_name, segment, balance,
  ROW_NUMBER() OVER (PARTITION BY segment ORDER BY balance DESC NULLS LAST, c_custkey) AS balance_rank
FROM (SELECT c_custkey, c_name, CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS segment,
    CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS balance FROM customer) c""",
    "phase_avg_pivot": f"""{SQL_FACTS_PREFIX}
SELECT exam_type, time_band,
  ROUND({_xavg("total_population", "phase = 'before'")}, 6) AS before_population,
  ROUND({_xavg("total_population", "phase = 'during'")}, 6) AS during_population,
  ROUND({_xavg("total_population", "phase = 'after'")}, 6) AS after_population
FROM pop WHERE phase IN ('before', 'during', 'after') AND semester IS NOT NULL
GROUP BY exam_type, time_band""",
    "group_phase_avg": f"""{SQL_FACTS_PREFIX}
SELECT semester, exam_type,
  ROUND({_xavg("total_population", "area_type = 'university' AND phase = 'before'")}, 6) AS univ_before,
  ROUND({_xavg("total_population", "area_type = 'university' AND phase = 'after'")}, 6) AS univ_after,
  ROUND({_xavg("total_population", "area_type = 'culture_university' AND phase = 'before'")}, 6) AS culture_before,
  ROUND({_xavg("total_population", "area_type = 'culture_university' AND phase = 'after'")}, 6) AS culture_after,
  ROUND({_xavg("total_population", "area_type = 'nightlife' AND phase = 'before'")}, 6) AS night_before,
  ROUND({_xavg("total_population", "area_type = 'nightlife' AND phase = 'after'")}, 6) AS night_after
FROM pop
WHERE phase IN ('before', 'after') AND semester IS NOT NULL
  AND area_type IN ('university', 'culture_university', 'nightlife')
GROUP BY semester, exam_type""",
    "guarded_ratio": f"""{SQL_FACTS_PREFIX},
d AS (
  SELECT date, area_id, SUM(CAST(ROUND(young_20s_population * 100) AS BIGINT)) AS y,
    SUM(CAST(ROUND(total_population * 100) AS BIGINT)) AS t
  FROM pop GROUP BY date, area_id)
SELECT date, area_id, ROUND(CASE WHEN t > 0 THEN CAST(y AS DOUBLE) / CAST(t AS DOUBLE) END, 6) AS young_share FROM d""",
    "resolve_columns_two_layouts": """SELECT CAST(e.ts AS DATE) AS date, CAST(hour(e.ts) AS INTEGER) AS hour,
  n.n_name AS raw_station_name, COUNT(*) AS alighting_count
FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE e.event_type = 'purchase' AND (hour(e.ts) >= 18 OR hour(e.ts) <= 2)
GROUP BY ALL""",
    "csv_roundtrip_utf8_bom": _PEOPLE_OBS_SQL,
    "csv_roundtrip_cp949": _PEOPLE_OBS_SQL,
    "nonempty_counts": """WITH p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase'),
e AS (SELECT user_id FROM p WHERE ts IS NOT NULL AND (hour(ts) >= 18 OR hour(ts) <= 2)),
k AS (SELECT e.user_id FROM e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey WHERE e.user_id % 9 <> 0)
SELECT 'feed parsing' AS stage, COUNT(*) AS row_count FROM p
UNION ALL SELECT 'night hours' AS stage, COUNT(*) AS row_count FROM e
UNION ALL SELECT 'unit lookup' AS stage, COUNT(*) AS row_count FROM k
UNION ALL SELECT 'area lookup' AS stage, COUNT(*) AS row_count FROM k WHERE user_id % 5 <> 0""",
}

ORACLE_SQL["calendar_overlap_days"] = ORACLE_SQL["calendar_overlap_check"]
