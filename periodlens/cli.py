"""Command-line entry for the jobs (K5: every path is an argument or derives
from ``--base-dir``).

    spark-submit --py-files periodlens.zip jobs.py --base-dir /data/analysis dimensions
    spark-submit --py-files periodlens.zip jobs.py --base-dir /data/analysis population
    python -m periodlens.cli ridership --input raw/subway/ --mapping m.csv --periods p.csv \
        --output processed/area_subway
    python -m periodlens.cli reports --population processed/area_population \
        --ridership processed/area_subway --results results --database analysis

The session comes from the submitter (``getOrCreate``); only the settings the
library needs are applied on top.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans import pipelines
from .session import configure
from .sources.dimensions import write_dimension_csvs


# Default layout below --base-dir (every path can still be given explicitly).
LAYOUT = {
    "people": "raw/people",
    "subway": "raw/subway",
    "mapping": "mapping/area_mapping.csv",
    "periods": "mapping/exam_periods.csv",
    "population": "processed/area_population",
    "ridership": "processed/area_subway",
    "results": "results",
}


def _under(base: str | None, key: str) -> str | None:
    return f"{base.rstrip('/')}/{LAYOUT[key]}" if base else None


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="periodlens")
    p.add_argument("--base-dir", default=None, help="root of the default folder layout (raw/, mapping/, processed/, results/)")
    sub = p.add_subparsers(dest="job", required=True)
    d = sub.add_parser("dimensions", help="write the shipped area mapping and calendar as CSV")
    d.add_argument("--output", default=None, help="folder (default: <base-dir>/mapping)")
    for name in ("population", "ridership"):
        j = sub.add_parser(name, help=f"build the {name} fact from raw CSV files")
        j.add_argument("--input", default=None, help="CSV file, folder or glob")
        j.add_argument("--mapping", default=None, help="area mapping CSV")
        j.add_argument("--periods", default=None, help="period calendar CSV")
        j.add_argument("--output", default=None, help="Parquet output folder (replaced)")
        j.add_argument("--encoding", default="auto", help="charset, or 'auto' to detect UTF-8 vs CP949 per file")
        j.add_argument("--single-layout", action="store_true",
                       help="all files share one header and the given --encoding: skip the profiling pass")
        j.add_argument("--manifest", default=None,
                       help="layout manifest folder: only files new since the last run are profiled, all layouts are read in one pass")
        j.add_argument("--partition-by", default="", help="comma-separated fact columns, e.g. year,month")
        j.add_argument("--replace-partitions", action="store_true",
                       help="with --partition-by: replace only the partitions this load contains")
        j.add_argument("--by-year", action="store_true", help="keep the calendar year as a key")
        j.add_argument("--late-night", default="same_day", choices=["same_day", "previous_day"])
    r = sub.add_parser("reports", help="run the report catalog over written facts")
    r.add_argument("--population", default=None)
    r.add_argument("--ridership", default=None)
    r.add_argument("--results", default=None, help="folder for ordered comma-delimited exports")
    r.add_argument("--database", default=None, help="save each report as a table in this database")
    r.add_argument("--names", default="", help="comma-separated report names (default: all)")
    r.add_argument("--by-year", action="store_true")
    r.add_argument("--scales", default="",
                   help="exact averages for decimal measures, e.g. total_population=2,young_20s_population=2")
    return p


def _resolve(args) -> None:
    """Fill unset paths from --base-dir; error if a path is still missing."""
    base = args.base_dir
    if args.job == "dimensions":
        args.output = args.output or (f"{base.rstrip('/')}/mapping" if base else None)
        needed = ["output"]
    elif args.job in ("population", "ridership"):
        args.input = args.input or _under(base, "people" if args.job == "population" else "subway")
        args.mapping = args.mapping or _under(base, "mapping")
        args.periods = args.periods or _under(base, "periods")
        args.output = args.output or _under(base, args.job)
        needed = ["input", "mapping", "periods", "output"]
    else:
        args.population = args.population or _under(base, "population")
        args.ridership = args.ridership or _under(base, "ridership")
        args.results = args.results or _under(base, "results")
        needed = ["population", "ridership"]
    missing = [n for n in needed if not getattr(args, n)]
    if missing:
        raise SystemExit(f"missing --{', --'.join(missing)} (or give --base-dir)")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    _resolve(args)
    spark = configure(SparkSession.builder.appName(f"periodlens-{args.job}").getOrCreate())
    if args.job == "dimensions":
        paths = write_dimension_csvs(spark, args.output)
        print(json.dumps(paths))
    elif args.job in ("population", "ridership"):
        options = {
            "encoding": args.encoding, "single_layout": args.single_layout, "manifest": args.manifest,
            "by_year": args.by_year, "late_night": args.late_night,
        }
        parts = tuple(c for c in args.partition_by.split(",") if c)
        io = (spark, args.input, args.mapping, args.periods, args.output, parts, args.replace_partitions)
        if args.job == "population":
            pipelines.population_job(*io, **options)
        else:
            counts = pipelines.ridership_job(*io, **options)
            print(json.dumps({"stage_rows": counts}))
    else:
        if args.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{args.database}`")
        names = [n for n in args.names.split(",") if n] or None
        scales = {k: int(v) for k, v in (item.split("=") for item in args.scales.split(",") if item)} or None
        pipelines.report_job(
            spark, args.population, args.ridership, args.results, args.database, names, args.by_year, scales
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
