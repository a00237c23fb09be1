"""Period labelling: attach (phase, exam_type, semester) to dated rows.

Two join forms give identical rows:

* ``expanded`` (default): the calendar is exploded to one row per day
  (``explode(sequence(start, end))``) and joined on the date.
* ``range``: periods are exploded to the months they touch and joined on the month,
  with ``start <= date <= end`` as a further condition. It suits calendars of long
  periods, where days would be many.

Both are equi-joins, planned by size like any other; neither form compares all
rows with all periods, and neither depends on how large the calendar is.

A row matching n periods fans out to n rows (periods are not expected to
overlap; :func:`overlapping_periods` reports any that do).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staging_path
from ..sources.dimensions import NORMAL

LABEL_COLUMNS = ["exam_year", "semester", "exam_type", "phase"]


def expand_calendar(calendar: DataFrame, date_col: str = "date") -> DataFrame:
    """One row per (day, period) (U2). Inverted or unparsable periods match nothing:
    they are filtered out because ``sequence`` would otherwise count downwards."""
    valid = calendar.filter(F.col("start_date") <= F.col("end_date"))
    return valid.select(
        F.explode(F.sequence("start_date", "end_date")).alias(date_col),
        *LABEL_COLUMNS,
    )


def previous_day_for_late_night(date: Column, hour: Column, last_hour: int = 2) -> Column:
    """Date that attributes hours 0..last_hour to the evening before (U4)."""
    return F.when(hour <= last_hour, F.date_sub(date, 1)).otherwise(date)


def label_periods(
    df: DataFrame,
    calendar: DataFrame,
    date_col: str = "date",
    strategy: str = "expanded",
    default: str = NORMAL,
) -> DataFrame:
    """Left-join the calendar on ``date_col`` and default unmatched labels.

    Adds ``exam_year``, ``semester`` (int, NULL when unmatched), ``exam_type`` and
    ``phase`` (``default`` when unmatched)."""
    if strategy not in ("expanded", "range"):
        raise ValueError(f"unknown strategy {strategy!r}; use 'expanded' or 'range'")
    if strategy == "range":
        month = lambda c: F.trunc(c, "month")
        periods = calendar.filter(F.col("start_date") <= F.col("end_date")).select(
            *LABEL_COLUMNS, F.col("start_date").alias("_start"), F.col("end_date").alias("_end"),
            F.explode(F.sequence(month("start_date"), month("end_date"), F.expr("interval 1 month"))).alias("_month"),
        )
        inside = F.col(date_col).between(F.col("_start"), F.col("_end"))
        joined = df.join(periods, (month(F.col(date_col)) == F.col("_month")) & inside, "left").drop("_start", "_end", "_month")
    else:
        joined = df.join(expand_calendar(calendar, date_col), date_col, "left")
    defaults = {
        "phase": F.coalesce(F.col("phase"), F.lit(default)),
        "exam_type": F.coalesce(F.col("exam_type"), F.lit(default)),
        "semester": F.col("semester").try_cast("int"),
    }
    return joined.select(*[defaults[c].alias(c) if c in defaults else F.col(c) for c in joined.columns])


def overlapping_periods(calendar: DataFrame, method: str = "sweep") -> DataFrame:
    """Calendar validator (Q3): for every period, its number of days and how many
    of them another period also covers. Identical periods are merged first (keeping their
    multiplicity); two identical periods overlap each other. Inverted or unparsable periods cover
    no day and are not reported.

    ``method="sweep"`` sweeps a line over the starts and ends: at most two events a period, however long it is. The
    running number of open periods tells which stretches two or more cover, the running length of
    these stretches is looked up at each period's start and end. Both running sums go over sorted ranges
    (:func:`running_total`). ``method="days"`` counts the periods of each day instead, a row per period and day."""
    period_key = [*LABEL_COLUMNS, "start_date", "end_date"]
    distinct = (
        calendar.filter(F.col("start_date") <= F.col("end_date"))
        .groupBy(*period_key)
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    if method == "days":
        return _overlaps_by_day(distinct, period_key)
    if method != "sweep":
        raise ValueError(f"unknown method {method!r}; use 'sweep' or 'days'")
    spark = calendar.sparkSession
    after = F.date_add("end_date", 1)
    events = distinct.select(F.col("start_date").alias("day"), F.col("_copies").alias("step")).unionByName(
        distinct.select(after.alias("day"), (-F.col("_copies")).alias("step"))
    )
    steps = events.groupBy("day").agg(F.sum("step").alias("step"))
    # open: periods that cover the days from this event to the next one
    open_ = running_total(spark, steps, "day", "step", "open", following="next_day")
    shared = open_.select("day", F.when(F.col("open") > 1, F.datediff("next_day", "day")).otherwise(0).cast("long").alias("shared"))
    until = running_total(spark, shared, "day", "shared", "total").select("day", (F.col("total") - F.col("shared")).alias("before"))
    starts, ends = (until.select(F.col("day").alias(d), F.col("before").alias(b)) for d, b in (("_from", "_shared_from"), ("_to", "_shared_to")))
    looked = distinct.withColumns({"_from": F.col("start_date"), "_to": after}).join(starts, "_from").join(ends, "_to")
    return looked.select(
        *period_key,
        (F.datediff("end_date", "start_date") + 1).cast("long").alias("period_days"),
        (F.col("_shared_to") - F.col("_shared_from")).alias("overlap_days"),
        (F.col("_shared_to") > F.col("_shared_from")).alias("is_overlapping"),
    )


def _overlaps_by_day(distinct: DataFrame, period_key: list[str]) -> DataFrame:
    days = distinct.select(*period_key, "_copies", F.explode(F.sequence("start_date", "end_date")).alias("day"))
    per_day = days.groupBy("day").agg(F.sum("_copies").alias("_periods_on_day"))
    covered = days.join(per_day, "day")
    per_period = covered.groupBy(*period_key).agg(
        F.count(F.lit(1)).alias("period_days"),
        F.sum(F.when(F.col("_periods_on_day") > 1, 1).otherwise(0)).cast("long").alias("overlap_days"),
    )
    return per_period.withColumn("is_overlapping", F.col("overlap_days") > 0)


def running_total(spark: SparkSession, df: DataFrame, order: str, value: str, name: str, following: str | None = None, ranges: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows up to this one by the unique key ``order``; and ``following``, the next row's key.

    The rows are dealt out in sorted ranges and written once; each range is summed on its own and shifted by what
    earlier ranges hold, a row per range. No task sees all rows."""
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = staging_path(spark, "running")
    df.repartitionByRange(ranges, order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    within, across = Window.partitionBy("_range").orderBy(order), Window.orderBy("_range")
    per_range = rows.groupBy("_range").agg(F.sum(value).alias("_held"), F.min(order).alias("_first"))
    shifts = per_range.select(
        F.col("_range"),
        F.coalesce(F.sum("_held").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"),
        F.lead("_first").over(across).alias("_after"),
    )
    out = rows.withColumn("_local", F.sum(value).over(within))
    if following is not None:
        out = out.withColumn("_next", F.lead(order).over(within))
    joined = out.join(shifts, "_range")
    more = [F.coalesce("_next", "_after").alias(following)] if following is not None else []
    return joined.select(*df.columns, (F.col("_local") + F.col("_shift")).alias(name), *more)
