"""A unit holding a third of all observations, with broadcasting off: the fact is summed per
(date, hour, unit) before the unit join, so the hot unit needs no splitting there and every
row is still counted."""

import datetime as dt

from pyspark.sql import functions as F

from periodlens.operators.facts import population_fact
from periodlens.sources.dimensions import calendar_from_rows

SMALL_AQE = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def test_hot_unit_is_summed_before_the_join(spark):
    saved = {k: spark.conf.get(k, None) for k in SMALL_AQE}
    try:
        for k, v in SMALL_AQE.items():
            spark.conf.set(k, v)
        n = 60000
        obs = spark.range(n).select(
            F.date_add(F.lit(dt.date(2025, 4, 14)), (F.col("id") % 7).cast("int")).alias("date"),
            (F.col("id") % 6 + 18).cast("int").alias("hour"),
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
            .alias("unit_code"),
            F.lit(1.0).alias("total_population"),
            F.lit(0.5).alias("young_20s_population"),
        )
        units = spark.range(5000).select(
            F.concat(F.lit("u"), F.col("id").cast("string")).alias("unit_code"),
            F.lit("a").alias("area_id"), F.lit("A").alias("area_name"), F.lit("university").alias("area_type"),
        ).union(spark.createDataFrame([("hot", "a", "A", "university")], "unit_code string, area_id string, area_name string, area_type string"))
        cal = calendar_from_rows(spark, [(2025, 1, "midterm", "before", dt.date(2025, 4, 14), dt.date(2025, 4, 20))])
        fact = population_fact(obs, units, cal)
        rows = fact.collect()
        assert sum(r["total_population"] for r in rows) == n
        assert len(rows) == 7 * 6
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [unit_code" in plan and "skew=true" not in plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
