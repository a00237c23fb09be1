"""Sinks and table management."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .plans.reports import REPORTS, order_columns

POPULATION_FACT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("day_of_week_num", T.IntegerType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("time_band", T.StringType()),
        T.StructField("area_id", T.StringType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("area_type", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("exam_type", T.StringType()),
        T.StructField("semester", T.IntegerType()),
        T.StructField("total_population", T.DoubleType()),
        T.StructField("young_20s_population", T.DoubleType()),
        T.StructField("young_20s_ratio", T.DoubleType()),
    ]
)
RIDERSHIP_FACT_SCHEMA = T.StructType(
    POPULATION_FACT_SCHEMA.fields[:14] + [T.StructField("alighting_count", T.LongType())]
)
FACT_SCHEMAS = {"area_population": POPULATION_FACT_SCHEMA, "area_subway": RIDERSHIP_FACT_SCHEMA}


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), replace_partitions_only: bool = False
) -> None:
    """Replace ``path`` with ``df`` as Parquet (K1). Partitioning the facts by
    (year, month) lets later reads prune whole directories.

    ``replace_partitions_only`` (with ``partition_by``) replaces just the
    partitions present in ``df`` (dynamic partition overwrite), so a monthly load
    rewrites its own months and leaves the others in place."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if replace_partitions_only:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_fact(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A fact directory with its fixed schema (S6): no inference job."""
    return spark.read.schema(FACT_SCHEMAS[table]).parquet(path)


def create_database(spark: SparkSession, name: str) -> None:
    """Namespace DDL (K4)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def use_database(spark: SparkSession, name: str) -> None:
    """Namespace DDL (K4)."""
    spark.sql(f"USE `{name}`")


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (K4)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_fact_table(spark: SparkSession, database: str, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """External Parquet table over a fact directory.

    For a directory written with ``partition_by``, the same columns make the table PARTITIONED BY: its partitions are registered in
    the catalog (:func:`register_partitions` adds later ones), which then prunes them without listing the others' files."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT_SCHEMAS[table].fields)
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE `{database}`.`{table}` ({cols}) USING parquet{parts} LOCATION '{location}'")
    if partition_by:
        register_partitions(spark, database, table)


def register_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Bring the catalog's partitions in line with the directory: new ones are added, gone ones dropped."""
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}` SYNC PARTITIONS")


def save_table(df: DataFrame, name: str) -> None:
    """Drop-and-create table as select, stored as Parquet (K2)."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


# Cells are written as they are; only one that holds the delimiter, a quote or a line break is quoted,
# and a quote inside it is doubled. Empty text is an empty cell, NULL is \\N.
EXPORT_FORMAT = {
    "header": "false", "nullValue": "\\N", "emptyValue": "", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def export_delimited(df: DataFrame, path: str, order: Sequence[str], columns: Sequence[str] | None = None) -> None:
    """Ordered, comma-delimited export without header; NULL written as ``\\N``
    (K3, O1). The total order is one range shuffle; part files follow each other in
    name order, so no task gathers the whole export."""
    out = df.select(*columns) if columns else df
    out.orderBy(*order_columns(list(order))).write.mode("overwrite").options(**EXPORT_FORMAT).csv(path)


def replace_path(spark: SparkSession, staged: str, output: str) -> None:
    """Put a finished folder in the place of ``output`` by renaming (K1): the old output goes
    last, and comes back if the new one can't take its place. Both lie in one file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    new, place, old = hadoop.Path(staged), hadoop.Path(output), hadoop.Path(f"{output.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"can't move {output} aside")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"can't publish {staged} as {output}")
    if had:
        files.delete(old, True)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def export_report(df: DataFrame, name: str, path: str) -> None:
    """Export a catalog report with its column list and order."""
    r = REPORTS[name]
    export_delimited(df, path, r.export_order, r.export_columns)
