"""Rejected rows, the sweep over the calendar, top k per group, partitioned tables, dates by arithmetic."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from periodlens.functions.columns import lenient_date
from periodlens.operators import periods, rejects
from periodlens.operators.ingest import PEOPLE_DATE, PEOPLE_HOUR, PEOPLE_TOTAL, PEOPLE_UNIT
from periodlens.operators.metrics import ranked, top_k_per_group
from periodlens.session import staging_path
from periodlens.sinks import register_fact_table, register_partitions, write_parquet
from periodlens.plans import catalog


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rejects_keep_every_row_with_its_first_reason(spark):
    cells = [
        ("20250101", "18", "u", "1.5"), ("20250101", " 18 ", "u", None), (None, "x", "u", "1"), ("20250230", "18", "u", "1"), ("20250101", "24", "u", "1"),
        ("20250101", "", "u", "1"), ("20250101", "3.0", "", "1"), ("20250101", "3", "u", "*"), ("2025-01-01", "3", "", "*"),
    ]
    raw = spark.createDataFrame(cells, f"`{PEOPLE_DATE}` string, `{PEOPLE_HOUR}` string, `{PEOPLE_UNIT}` string, `{PEOPLE_TOTAL}` string")
    rules = rejects.people_rules()
    checked = rejects.with_reason(raw, rules)
    path = staging_path(spark, "split")
    counts = rejects.write_split(checked, rules, path)
    assert counts == {"accepted": 2, "no date": 1, "bad date": 2, "no hour": 1, "bad hour": 1, "no unit": 1, "bad total": 1}
    good, bad = (rejects.read_split(spark, path, s, checked) for s in (rejects.ACCEPTED, rejects.REJECTED))
    assert good.columns == raw.columns and bad.columns == [*raw.columns, "reason"]
    assert rows(good.union(bad.drop("reason"))) == rows(raw)
    assert "PartitionFilters: [isnotnull(status" in plan(good)


def test_rejects_of_an_empty_feed_and_clashing_columns(spark):
    raw = spark.createDataFrame([], f"`{PEOPLE_DATE}` string, `{PEOPLE_HOUR}` string, `{PEOPLE_UNIT}` string, `{PEOPLE_TOTAL}` string")
    rules = rejects.people_rules()
    counts = rejects.write_split(rejects.with_reason(raw, rules), rules, staging_path(spark, "split"))
    assert set(counts.values()) == {0}
    with pytest.raises(ValueError, match="reason"):
        rejects.with_reason(raw.withColumn("reason", F.lit(1)), rules)


def calendar(spark, spans):
    day = lambda n: None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)
    return spark.createDataFrame([(2024, 1, "e", f"p{k}", day(a), day(b)) for k, a, b in spans], "exam_year int, semester int, exam_type string, phase string, start_date date, end_date date")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sweep_equals_counting_days(spark, seed):
    rng = random.Random(seed)
    spans = [(i % 7, a := rng.randrange(0, 300), a + rng.choice([-1, 0, 1, 5, 40])) for i in range(40)]
    spans += [spans[0], spans[0], spans[1], (9, None, 3), (9, 3, None), (8, 1000, 1000), (8, 1001, 1003), (8, 2000, 3000)]
    cal = calendar(spark, spans)
    assert rows(periods.overlapping_periods(cal)) == rows(periods.overlapping_periods(cal, method="days"))


def test_sweep_cost_does_not_grow_with_the_periods(spark):
    long = calendar(spark, [(1, 0, 2_000_000), (2, 100, 1_900_000), (3, 2_000_001, 2_500_000)])
    got = {r["phase"]: (r["period_days"], r["overlap_days"]) for r in periods.overlapping_periods(long).collect()}
    assert got == {"p1": (2_000_001, 1_899_901), "p2": (1_899_901, 1_899_901), "p3": (500_000, 0)}
    assert "Generate" not in plan(periods.overlapping_periods(long))
    assert not periods.overlapping_periods(calendar(spark, [])).collect()


def test_running_total_over_ranges(spark):
    df = spark.range(500).select((F.col("id") * 37 % 503).alias("k"), (F.col("id") % 5 - 2).alias("v")).repartition(6)
    got = periods.running_total(spark, df, "k", "v", "sum", following="next", ranges=9).orderBy("k").collect()
    total, keys = 0, [r["k"] for r in got]
    for i, r in enumerate(got):
        total += r["v"]
        assert r["sum"] == total and r["next"] == (keys[i + 1] if i + 1 < len(keys) else None)


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 4999).alias("v"), "id")
    top = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 4)
    text = plan(top)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text
    assert rows(top) == rows(ranked(df, ["g"], "v", tiebreak=["id"]).filter("rank_no <= 4"))


def test_partitioned_table_prunes_by_the_catalog(spark):
    pop = catalog.event_population_fact(spark, "/root/testdata/sf0.001")
    base = staging_path(spark, "table")
    db = "periodlens_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE `{db}` LOCATION '{base}/warehouse'")
    path, by = f"{base}/fact", ("year", "month", "day_of_week_num")
    write_parquet(pop.filter("day_of_week_num < 4"), path, by)
    register_fact_table(spark, db, "area_population", path, by)
    seen = spark.sql(f"SHOW PARTITIONS `{db}`.area_population").count()
    write_parquet(pop.filter("day_of_week_num >= 4"), path, by, replace_partitions_only=True)
    register_partitions(spark, db, "area_population")
    assert spark.sql(f"SHOW PARTITIONS `{db}`.area_population").count() > seen
    table = spark.table(f"{db}.area_population")
    assert rows(table.select(*pop.columns)) == rows(pop)
    one = table.filter("day_of_week_num = 2")
    assert "PartitionFilters: [isnotnull(day_of_week_num" in plan(one)
    assert one.count() == pop.filter("day_of_week_num = 2").count()


def test_dates_by_arithmetic_equal_the_parser(spark):
    rng = random.Random(4)
    texts = [f"{rng.randrange(0, 10000):04}{rng.randrange(0, 15):02}{rng.randrange(0, 34):02}" for _ in range(3000)]
    texts += ["20240229", "20230229", "19000229", "20000229", "2024.02.29", "2024-2-9", "", None, "2024010", "202401011", "x", "00000101", "00010101", "99991231", "２０２４０１０１"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    digits = F.regexp_replace("t", "[^0-9]", "")
    wrong = df.filter(~lenient_date("t").eqNullSafe(F.try_to_date(digits, "yyyyMMdd")))
    assert not wrong.collect()
