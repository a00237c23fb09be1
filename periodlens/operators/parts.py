"""Mergeable facts (K1, A1, A2): stored partial sums per source, so that a late or corrected file replaces its own part.

A store is a folder with

* ``parts/date=.../``: sums per (source, hour, unit) of each day; ``source`` is the file or load a row came from;
* ``index``: which days each source has rows for;
* ``fact/date=.../``: the fact folded from the parts.

:func:`load` takes the observations of some sources, whether they are new or stand in for what these sources held before.
Only the days touched (those the sources had, and those they have now) are read, written and folded again; everything else
stays as it is. A load first writes what the touched days will hold beside the store (``pending``) and then puts it in place; if
the driver dies in between, the next load (or :func:`recover`) finishes it, so no step is lost or done twice.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stable import STABLE
from ..sinks import delete_path, replace_path, write_parquet
from .facts import Measure

#: a day's partition is a folder; a load may touch this many (a bound on the list that the driver holds)
MOST_DAYS = 100_000


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def parts_of(observations: DataFrame, measures: Sequence[Measure], unit_col: str) -> DataFrame:
    """Sums per (date, source, hour, unit); rows without a date or hour hold nothing."""
    rows = observations.filter(F.col("date").isNotNull() & F.col("hour").isNotNull())
    sums = rows.groupBy("date", "source", F.col("hour").cast("int").alias("hour"), unit_col).agg(*[m.partial() for m in measures])
    return sums.select("date", "source", "hour", unit_col, *[_value(m) for m in measures])


def _value(m: Measure):
    """A partial sum in the measure's own unit; whole units of a scale divide exactly enough to be read back."""
    return (F.col(m.name) if m.scale in (None, STABLE) else F.col(m.name).cast("double") / float(10**m.scale)).cast(m.dtype).alias(m.name)


def read_parts(spark: SparkSession, store: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """The stored parts, of some days if given (a filter on the partition column: other days' folders aren't opened)."""
    rows = spark.read.schema(_schema(spark, store)).parquet(f"{store}/parts")
    return rows if days is None else rows.filter(F.col("date").isin(*days))


def _schema(spark: SparkSession, store: str) -> T.StructType:
    fields = spark.read.parquet(f"{store}/index_schema").schema.fields
    return T.StructType(fields)


def load(
    spark: SparkSession,
    store: str,
    observations: DataFrame,
    measures: Sequence[Measure],
    build: Callable[[DataFrame], DataFrame],
    unit_col: str = "unit_code",
    sources: Iterable[str] | None = None,
    day_shift: int = 0,
) -> list[dt.date]:
    """Put the sources' rows in the place of what they held, and fold the touched days again; returns these days.

    ``observations`` has ``source, date, hour, <unit_col>, measures...``. ``sources`` names sources that may have no row any more.
    ``build`` makes the fact from observations (their ``source`` column is gone). ``day_shift=1``: the fact files some hours
    under the day before (``late_night="previous_day"``)."""
    recover(spark, store, build, day_shift)
    pending = f"{store}/pending"
    delete_path(spark, f"{pending}.new")
    new = parts_of(observations, measures, unit_col)
    new.write.parquet(f"{pending}.new/rows")
    if not _exists(spark, f"{store}/index_schema"):
        empty = spark.createDataFrame([], T.StructType([f for f in new.schema.fields if f.name != "date"] + [new.schema["date"]]))
        empty.write.parquet(f"{store}/index_schema")
        empty.write.parquet(f"{store}/parts")
        spark.createDataFrame([], "source string, date date").write.parquet(f"{store}/index")
    rows = spark.read.schema(new.schema).parquet(f"{pending}.new/rows")
    loaded = rows.select("source").distinct()
    if sources is not None:
        loaded = loaded.union(spark.createDataFrame([(s,) for s in sources], "source string")).distinct()
    index = spark.read.schema("source string, date date").parquet(f"{store}/index")
    touched = rows.select("date").union(index.join(loaded, "source", "left_semi").select("date")).distinct()
    days = sorted(r["date"] for r in touched.limit(MOST_DAYS + 1).collect())
    if len(days) > MOST_DAYS:
        raise ValueError(f"a load touches more than {MOST_DAYS} days")
    kept = read_parts(spark, store, days).join(loaded, "source", "left_anti")
    kept.select(rows.columns).unionByName(rows).write.parquet(f"{pending}.new/parts")
    others = index.join(loaded, "source", "left_anti")
    others.unionByName(rows.select("source", "date").distinct()).write.parquet(f"{pending}.new/index")
    spark.createDataFrame([(d, None) for d in days], "date date, note string").coalesce(1).write.parquet(f"{pending}.new/days")
    replace_path(spark, f"{pending}.new", pending)  # from here on the load is decided
    recover(spark, store, build, day_shift)
    return days


def recover(spark: SparkSession, store: str, build: Callable[[DataFrame], DataFrame], day_shift: int = 0) -> None:
    """Finish a load that was decided: each step may be done again."""
    pending = f"{store}/pending"
    if not _exists(spark, pending):
        return
    days = sorted(r["date"] for r in spark.read.parquet(f"{pending}/days").collect())
    schema = _schema(spark, store)
    staged = spark.read.schema(schema).parquet(f"{pending}/parts")
    _put(spark, staged, f"{store}/parts", days)
    spark.read.schema("source string, date date").parquet(f"{pending}/index").write.mode("overwrite").parquet(f"{store}/index")
    filed = sorted({d - dt.timedelta(days=s) for d in days for s in range(day_shift + 1)})
    needed = sorted({d + dt.timedelta(days=s) for d in filed for s in range(day_shift + 1)})
    fact = build(read_parts(spark, store, needed).drop("source"))
    path = f"{pending}/fact"
    fact.filter(F.col("date").isin(*filed)).write.mode("overwrite").parquet(path)
    _put(spark, spark.read.schema(fact.schema).parquet(path), f"{store}/fact", filed)
    delete_path(spark, pending)


def _put(spark: SparkSession, rows: DataFrame, path: str, days: Sequence[dt.date]) -> None:
    """Replace the days' partitions by the rows; a day without rows has no partition."""
    write_parquet(rows, path, ("date",), replace_partitions_only=True)
    left = {r["date"] for r in rows.select("date").distinct().collect()}
    for day in days:
        if day not in left:
            delete_path(spark, f"{path}/date={day.isoformat()}")


def read_folded(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The store's fact."""
    return spark.read.schema(schema).parquet(f"{store}/fact").select(schema.names)
