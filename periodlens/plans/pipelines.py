"""End-to-end jobs: raw CSV feeds -> facts -> reports.

``population_job`` / ``ridership_job`` are the fact builds (scan, clean, map,
label, roll up, write); ``report_job`` reads the written facts once and produces
every report as a table and an ordered delimited export. Paths and options are
plain arguments (K5).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facts import population_fact, ridership_fact
from ..operators.ingest import PEOPLE_WANTED, SUBWAY_OPTIONAL, SUBWAY_WANTED, people_observations, subway_observations
from ..operators.lattice import MEASURES, Lattice, lattice
from ..operators.quality import Gates
from ..session import staging_path
from ..sinks import delete_path, export_report, read_fact, replace_path, save_table, write_parquet
from ..sources.csv import read_csv_layouts
from ..sources.dimensions import (
    read_small_csv,
    station_names,
    stations_to_areas,
    typed_periods,
    units_to_areas,
)
from ..sources.manifest import read_csv_manifest, update_manifest
from .reports import REPORTS


def load_dimensions(spark: SparkSession, mapping_path: str, periods_path: str) -> tuple[DataFrame, DataFrame]:
    """(area mapping, typed calendar) from the two dimension CSVs."""
    return read_small_csv(spark, mapping_path), typed_periods(read_small_csv(spark, periods_path))


def _by_manifest(spark: SparkSession, path: str, manifest: str, wanted: dict, optional=()) -> DataFrame:
    """A feed read through its layout manifest, which learns the files that are new."""
    update_manifest(spark, path, manifest)
    return read_csv_manifest(spark, path, manifest, wanted, optional)


def population_fact_from_csv(
    spark: SparkSession,
    people_path: str,
    mapping_path: str,
    periods_path: str,
    encoding: str = "auto",
    single_layout: bool = False,
    manifest: str | None = None,
    **options,
) -> DataFrame:
    if manifest is not None:
        obs = people_observations(_by_manifest(spark, people_path, manifest, PEOPLE_WANTED))
    else:
        obs = read_csv_layouts(spark, people_path, encoding, per_layout=people_observations, single_layout=single_layout)
    mapping, calendar = load_dimensions(spark, mapping_path, periods_path)
    return population_fact(obs, units_to_areas(mapping), calendar, **options)


def station_units(spark: SparkSession, mapping: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Native station name -> areas (J2, J3): the two dimensions joined to each other
    first, so the fact is joined once. ``names`` (raw_station_name, station_name) is the
    shipped name table unless given. A name without an area keeps NULL areas, so that an
    unknown name and an unmapped station can be told apart (Q1)."""
    shipped = names is None
    names = station_names(spark) if shipped else names
    areas = stations_to_areas(mapping)
    if shipped:
        return F.broadcast(names).join(areas, "station_name", "left")
    return names.join(areas, "station_name", "left")


def ridership_fact_from_csv(
    spark: SparkSession,
    subway_path: str,
    mapping_path: str,
    periods_path: str,
    encoding: str = "auto",
    gates: Gates | None = None,
    single_layout: bool = False,
    manifest: str | None = None,
    **options,
) -> DataFrame:
    if manifest is not None:
        obs = subway_observations(_by_manifest(spark, subway_path, manifest, SUBWAY_WANTED, SUBWAY_OPTIONAL))
    else:
        obs = read_csv_layouts(spark, subway_path, encoding, per_layout=subway_observations, single_layout=single_layout)
    mapping, calendar = load_dimensions(spark, mapping_path, periods_path)
    if gates is not None:
        obs = gates.watch(obs, "feed parsing")
    units = station_units(spark, mapping)
    return ridership_fact(obs, units, calendar, unit_col="raw_station_name", gates=gates, **options)


def _publish(
    spark: SparkSession, fact: DataFrame, output: str, partition_by=(), replace_partitions_only=False, check=lambda: None
) -> None:
    """Write a fact beside its output, then put it in place (K1).

    The long raw-feed job never writes to ``output`` itself: if it or ``check`` fails, the previous
    output stays, and what was staged is removed. A whole output is replaced by renaming;
    with ``replace_partitions_only`` the staged rows are copied over their partitions."""
    staged = f"{output.rstrip('/')}.staged-{uuid.uuid4().hex[:8]}"
    try:
        write_parquet(fact, staged, () if replace_partitions_only else partition_by)
        check()
        if replace_partitions_only:
            write_parquet(spark.read.schema(fact.schema).parquet(staged), output, partition_by, True)
        else:
            replace_path(spark, staged, output)
    finally:
        delete_path(spark, staged)


def population_job(
    spark, people_path, mapping_path, periods_path, output, partition_by=(), replace_partitions_only=False, **options
) -> None:
    fact = population_fact_from_csv(spark, people_path, mapping_path, periods_path, **options)
    _publish(spark, fact, output, partition_by, replace_partitions_only)


def ridership_job(
    spark, subway_path, mapping_path, periods_path, output, partition_by=(), replace_partitions_only=False, **options
) -> dict[str, int]:
    """Build the ridership fact; publish it to ``output`` only if every stage
    produced rows (gates are counted by the staging job; a failed gate leaves
    ``output`` as it was)."""
    gates = Gates("ridership")
    fact = ridership_fact_from_csv(spark, subway_path, mapping_path, periods_path, gates=gates, **options)
    fact = gates.watch(fact, "roll-up")
    _publish(spark, fact, output, partition_by, replace_partitions_only, gates.check)
    return gates.counts()


def staged_lattice(spark: SparkSession, fact: DataFrame, table: str, by_year: bool = False, scales: dict[str, int] | None = None) -> Lattice:
    """The lattice of a fact, written to the staging folder and read back."""
    made = lattice(fact, MEASURES[table], by_year, scales)
    path = staging_path(spark, f"lattice-{table}")
    made.frame.write.parquet(path)
    return Lattice(spark.read.schema(made.frame.schema).parquet(path), made.scales)


def report_job(
    spark: SparkSession,
    population_path: str,
    ridership_path: str,
    results_dir: str | None = None,
    database: str | None = None,
    names: list[str] | None = None,
    by_year: bool = False,
    scales: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Run reports over written facts; optionally save tables and exports.
    ``scales`` (measure -> decimals) makes those measures' averages exact.

    Each fact is scanned once: its lattice is written to the staging folder, all reports fold that."""
    if by_year:
        pop, rid = spark.read.parquet(population_path), spark.read.parquet(ridership_path)
    else:
        pop = read_fact(spark, population_path, "area_population")
        rid = read_fact(spark, ridership_path, "area_subway")
    pop, rid = (staged_lattice(spark, fact, table, by_year, scales) for fact, table in ((pop, "area_population"), (rid, "area_subway")))
    out = {}
    for name in names or list(REPORTS):
        df = REPORTS[name].build(pop, rid, by_year=by_year, scales=scales)
        if database:
            save_table(df, f"{database}.result_{name}")
            df = spark.table(f"{database}.result_{name}")
        if results_dir:
            export_report(df, name, f"{results_dir}/{name}")
        out[name] = df
    return out
