"""Layout manifest of landed CSV files (U1, S8): which charset and header each file has.

The manifest is a Parquet folder with one row per file version: path, size, modification time,
charset, header line. :func:`update_manifest` scans the bytes of files that are not in it yet and appends their
rows; files known with the same size and time are listed, never read. :func:`read_csv_manifest` then reads all files
in **one** pass, whatever their layouts: cells are parsed by position as single-byte text, and each
wanted column is picked and decoded by the row's layout. Neither brings a row per file to the driver; what comes there
is one row per distinct layout, and the oldest time among new files, by which the scan leaves out older ones.
"""

from __future__ import annotations

import csv
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_header_name
from ..session import staging_path
from .csv import DEFAULT_LEGACY_ENCODING, UTF8, decodes, resolve_columns

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("charset", T.StringType()),  # NULL: valid in none
        T.StructField("header", T.StringType()),
    ]
)
VERSION = ["path", "size", "modified"]
#: files whose layout numbers are sent to every task (some 150 bytes each); beyond, the join shuffles
MOST_SENT = 200_000
#: distinct (charset, header) pairs a feed may have
MOST_LAYOUTS = 1_000
_BYTES = "ISO-8859-1"  # each byte is one character, so any charset's bytes come through


def _version() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def _list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def listed_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The versions of the files there are: a listing, no content."""
    return spark.read.format("binaryFile").load(_list(paths)).select(*_version())


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The manifest's rows (none if it has not been written yet)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(manifest)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)


def profiled(spark: SparkSession, paths: str | Sequence[str], since=None, legacy: str = DEFAULT_LEGACY_ENCODING) -> DataFrame:
    """Manifest rows of the files changed at ``since`` or later, from their bytes.

    Older files are left out of the scan by the planner (a filter on the file's time prunes the listing)."""
    lines = spark.read.text(_list(paths))
    if since is not None:
        lines = lines.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    lines = lines.select("value", *_version(), F.col("_metadata.file_block_start").alias("block")).withColumn("row_id", F.monotonically_increasing_id())
    per_file = lines.groupBy(*VERSION).agg(
        F.min(decodes("value", UTF8)).alias("utf8"),
        F.min(decodes("value", legacy)).alias("legacy"),
        F.min_by(F.col("value").cast("binary"), F.struct("block", "row_id")).alias("first"),
    )
    charset = F.when(F.col("utf8"), F.lit(UTF8)).when(F.col("legacy"), F.lit(legacy))
    header = F.when(charset == UTF8, F.decode("first", UTF8)).otherwise(F.decode("first", legacy))
    return per_file.select(*VERSION, charset.alias("charset"), header.alias("header"))


def update_manifest(spark: SparkSession, paths: str | Sequence[str], manifest: str, legacy: str = DEFAULT_LEGACY_ENCODING) -> int:
    """Add the files that are new or changed since the last update; returns how many were added.

    A file that is valid in no charset is recorded as such; reading it is an error. Empty files aren't listed."""
    known = read_manifest(spark, manifest).select(*VERSION)
    new = listed_files(spark, paths).join(known, VERSION, "left_anti")
    found = new.agg(F.count(F.lit(1)).alias("n"), F.min("modified").alias("since")).first()
    if not found["n"]:
        return 0
    rows = profiled(spark, paths, found["since"], legacy).join(known, VERSION, "left_anti")
    rows.write.mode("append").parquet(manifest)
    return int(found["n"])


def _layouts(entries: DataFrame) -> list[tuple[str, str]]:
    """The distinct (charset, header) of the files."""
    rows = entries.groupBy("charset", "header").agg(F.count(F.lit(1)).alias("files")).limit(MOST_LAYOUTS + 1).collect()
    if len(rows) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} layouts: these files are not one feed")
    return sorted((r["charset"], r["header"]) for r in rows)


def _checked(entries: DataFrame) -> None:
    """Every listed file has to be known, in a charset."""
    bad = entries.where(F.col("header").isNull() | F.col("charset").isNull())
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path"), F.min(F.col("header").isNull()).alias("new")).first()
    if found["n"]:
        why = "not in the manifest yet (update it first)" if found["new"] else "in no known charset or not in the manifest"
        raise ValueError(f"{found['n']} files are {why}, e.g. {found['path']}")


def read_csv_manifest(
    spark: SparkSession,
    paths: str | Sequence[str],
    manifest: str,
    wanted: dict[str, Sequence[str]] | None = None,
    optional: Iterable[str] = (),
) -> DataFrame:
    """All files as one frame of strings, in one pass over their bytes.

    ``wanted`` maps each output column to the names it may have in a header, best first; each layout is
    resolved against its own header (P3), and a missing required name is an error that says so (Q2). Without it, the columns are
    all header names, NULL where a layout lacks one."""
    entries = listed_files(spark, paths).join(read_manifest(spark, manifest), VERSION, "left")
    _checked(entries)
    layouts = _layouts(entries)
    if not layouts:
        raise ValueError(f"no input files under {paths!r}")
    names = [[clean_header_name(n) for n in next(csv.reader([header]))] for _, header in layouts]
    if wanted is None:
        wanted = {n: [n] for header in names for n in header}
        optional = list(wanted)
    found = [resolve_columns(header, wanted, optional) for header in names]

    columns = [f"c{i}" for i in range(max(map(len, names)))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("encoding", _BYTES).csv(_list(paths))
    numbers = spark.createDataFrame([(i, *layout) for i, layout in enumerate(layouts)], "layout int, charset string, header string")
    of = entries.join(F.broadcast(numbers), ["charset", "header"]).select("path", "layout")
    if entries.count() <= MOST_SENT:
        of = F.broadcast(of)
    rows = raw.withColumn("path", F.col("_metadata.file_path")).join(of, "path")

    def cell(key: str) -> Column:
        out = F.lit(None).cast("string")
        for i, ((charset, _), header) in enumerate(zip(layouts, names)):
            if key in found[i]:
                place = F.encode(F.col(columns[header.index(found[i][key])]), _BYTES)
                out = F.when(F.col("layout") == i, F.decode(place, charset)).otherwise(out)
        return out

    return rows.select(*[cell(key).alias(key) for key in wanted])


def staged_manifest(spark: SparkSession, paths: str | Sequence[str], legacy: str = DEFAULT_LEGACY_ENCODING) -> str:
    """A manifest of its own in the staging folder, for a feed that is read once."""
    manifest = staging_path(spark, "manifest")
    update_manifest(spark, paths, manifest, legacy)
    return manifest
