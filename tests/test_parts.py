"""Mergeable facts: incremental loads equal a full build and touch only their days."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from periodlens.operators import parts
from periodlens.operators.facts import Measure
from periodlens.session import staging_path

MEASURES = [Measure("v", None, "long")]
OBS = "source string, date date, hour int, unit_code int, v long"


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def build(rows):
    return rows.groupBy("date", "hour").agg(F.sum("v").alias("v"), F.countDistinct("unit_code").alias("units"))


def shifted(rows):
    return build(rows.withColumn("date", F.when(F.col("hour") < 3, F.date_sub("date", 1)).otherwise(F.col("date"))))


def obs(spark, *rows):
    return spark.createDataFrame([(s, None if d is None else day(d), h, u, v) for s, d, h, u, v in rows], OBS)


def fact(spark, store):
    schema = "hour int, v long, units long, date date"
    return {(r["date"], r["hour"]): (r["v"], r["units"]) for r in spark.read.schema(schema).parquet(f"{store}/fact").collect()}


def local(path):
    return path.removeprefix("file:").replace("///", "/")


def full(spark, *frames, make=build):
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.union(f)
    rows = whole.filter("date is not null and hour is not null").drop("source")
    return {(r["date"], r["hour"]): (r["v"], r["units"]) for r in make(rows).collect()}


def test_loads_equal_a_full_build(spark):
    store = staging_path(spark, "store")
    a = obs(spark, ("a", 0, 20, 1, 5), ("a", 0, 20, 2, 6), ("a", 1, 21, 1, 7), ("a", 1, 21, 1, 1), ("a", None, 3, 1, 9), ("a", 2, None, 1, 9))
    b = obs(spark, ("b", 1, 21, 3, 70), ("b", 2, 0, 1, 8), ("b", 2, 0, 1, None))
    assert parts.load(spark, store, a, MEASURES, build) == [day(0), day(1)]
    assert parts.load(spark, store, b, MEASURES, build) == [day(1), day(2)]
    assert fact(spark, store) == full(spark, a, b)
    corrected = obs(spark, ("a", 0, 20, 1, 50), ("a", 3, 19, 1, 1))
    assert parts.load(spark, store, corrected, MEASURES, build) == [day(0), day(1), day(3)]
    assert fact(spark, store) == full(spark, corrected, b)
    assert parts.load(spark, store, corrected, MEASURES, build) == [day(0), day(3)]  # the same file again
    assert fact(spark, store) == full(spark, corrected, b)
    assert parts.load(spark, store, obs(spark), MEASURES, build, sources=["a", "never seen"]) == [day(0), day(3)]
    assert fact(spark, store) == full(spark, b)
    assert not os.path.exists(local(f"{store}/parts/date={day(3)}"))


def test_only_touched_days_are_read_and_written(spark):
    store = staging_path(spark, "store")
    parts.load(spark, store, obs(spark, *[("a", d, 20, 1, d) for d in range(6)]), MEASURES, build)
    before = {d: os.stat(local(f"{store}/fact/date={day(d)}")).st_mtime_ns for d in range(6)}
    parts.load(spark, store, obs(spark, ("b", 2, 20, 1, 100)), MEASURES, build)
    changed = {d for d in range(6) if os.stat(local(f"{store}/fact/date={day(d)}")).st_mtime_ns != before[d]}
    assert changed == {2}
    plan = parts.read_parts(spark, store, [day(2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan
    assert all("date=2025-01-03" in f for f in parts.read_parts(spark, store, [day(2)]).inputFiles()) or "PartitionFilters" in plan


def test_hours_filed_under_the_day_before(spark):
    store = staging_path(spark, "store")
    a = obs(spark, ("a", 1, 1, 1, 5), ("a", 1, 20, 1, 6), ("a", 2, 2, 1, 7))
    b = obs(spark, ("b", 2, 1, 1, 50), ("b", 3, 0, 2, 1))
    for rows in (a, b):
        parts.load(spark, store, rows, MEASURES, shifted, day_shift=1)
    assert fact(spark, store) == full(spark, a, b, make=shifted)


@pytest.mark.parametrize("dies_in", ["parts", "fact"])
def test_a_load_that_died_is_finished_by_the_next(spark, monkeypatch, dies_in):
    store = staging_path(spark, "store")
    a, b = obs(spark, ("a", 0, 20, 1, 5), ("a", 1, 20, 1, 6)), obs(spark, ("b", 1, 20, 2, 7))
    parts.load(spark, store, a, MEASURES, build)
    put = parts._put

    def dying(spark, rows, path, days):
        if path.endswith(dies_in):
            raise RuntimeError("lost")
        put(spark, rows, path, days)

    monkeypatch.setattr(parts, "_put", dying)
    with pytest.raises(RuntimeError):
        parts.load(spark, store, b, MEASURES, build)
    monkeypatch.setattr(parts, "_put", put)
    parts.recover(spark, store, build)
    assert fact(spark, store) == full(spark, a, b)
    assert not os.path.exists(local(f"{store}/pending"))
