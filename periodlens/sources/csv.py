"""Raw CSV sources: all-string reads, header cleaning, encoding detection, and a
layout-safe multi-file reader.

Why a layout-safe reader: given a glob of CSV files whose headers differ (two
naming schemes of the hour columns, or a different column order), Spark's CSV
source takes one header and binds every other file **by position**, silently
mixing columns. Two ways lead past that:

* **Stated layouts** (:class:`CsvLayout`): the caller names the charset of each folder; every
  file of a folder has the same header (checked by the reader). The bytes are read
  once, cells that don't decode raise an error that names the file. This is the way for
  large feeds.
* **Detected layouts**: one distributed text scan profiles every file (header line, charset), then
  each (charset, header) group is read with its own header and the groups are unioned by
  column name. It reads the bytes twice and brings one row per file to the driver: for
  folders of some thousand files.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clean_header_name

UTF8 = "UTF-8"
# Charset tried for files that are not valid UTF-8 (a superset of EUC-KR).
DEFAULT_LEGACY_ENCODING = "CP949"


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename columns whose header carries a BOM, quotes, blanks or a leading '?' (S7)."""
    cleaned = [clean_header_name(c) for c in df.columns]
    return df if cleaned == df.columns else df.toDF(*cleaned)


def read_csv_strings(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = UTF8, strict: bool = False
) -> DataFrame:
    """Header CSV with every column as a string, headers cleaned.

    ``strict`` checks, while reading, that every file has the same header and that every cell decodes;
    the error names the file. Non-UTF-8 charsets such as CP949 need
    ``spark.sql.legacy.javaCharsets=true`` (set by :func:`periodlens.session.configure`).
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not strict:
        return clean_columns(reader.option("encoding", encoding).csv(paths))
    # every byte is read as one character, so a cell's own bytes can be checked and decoded
    frame = reader.option("encoding", _BYTES).option("enforceSchema", False).csv(paths)
    cells = [F.encode(F.col("`" + c.replace("`", "``") + "`"), _BYTES) for c in frame.columns]
    names = spark.range(1).select(*[F.decode(F.lit(bytearray(c, "latin-1")), encoding) for c in frame.columns]).first()
    # the check stands in every cell, so it runs for the columns that are read, and only for those
    message = F.concat(F.lit(f"not valid {encoding}: "), F.col("_metadata.file_path"))
    checked = [F.when(~_valid(c, encoding), F.raise_error(message).cast("string")).otherwise(F.decode(c, encoding)) for c in cells]
    return clean_columns(frame.select(*[c.alias(n) for c, n in zip(checked, names)]))


_BYTES = "ISO-8859-1"
_GLOB_CHARS = "\\[]{}*?"


def _valid(raw: Column, charset: str) -> Column:
    """Whether bytes are text in a charset: they come back when decoded and encoded again."""
    if charset.upper().replace("-", "") == "UTF8":
        return F.is_valid_utf8(raw.cast("string"))
    return F.encode(F.decode(raw, charset), charset) == raw


def literal_path(uri: str) -> str:
    """A path for Spark's readers from a ``_metadata.file_path`` value: the URI is
    percent-decoded (spaces arrive as ``%20``) and glob characters are escaped,
    so a file named ``a [1].csv`` is read as itself, not as a pattern."""
    path = unquote(uri)
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


@dataclass(frozen=True)
class CsvLayout:
    """Files (a folder or glob) that share one header and one charset."""

    path: str
    encoding: str = UTF8


@dataclass(frozen=True)
class FileProfile:
    path: str
    utf8: bool
    legacy: bool
    header: str

    def charset(self, legacy_encoding: str) -> str:
        return UTF8 if self.utf8 else legacy_encoding


def file_profiles(
    spark: SparkSession, paths: str | Sequence[str], legacy: str = DEFAULT_LEGACY_ENCODING
) -> list[FileProfile]:
    """One distributed text scan -> (path, valid UTF-8, valid ``legacy``, first line) per file.

    Whole files are checked, not only their first block. The first line is the line with
    the smallest (block start, row id) of each file: rows of one split keep their order in
    ``monotonically_increasing_id``. A file that is valid in neither charset is an error.
    """
    text = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("row_id", F.monotonically_increasing_id())
    utf8 = F.is_valid_utf8("value")
    per_file = lines.groupBy("path").agg(
        F.min(utf8).alias("utf8"),
        F.min(F.when(utf8, True).otherwise(decodes("value", legacy))).alias("legacy"),
        F.min_by("value", F.struct("block", "row_id")).alias("header"),
    )
    found = [FileProfile(literal_path(r["path"]), bool(r["utf8"]), bool(r["legacy"]), r["header"] or "") for r in per_file.collect()]
    bad = sorted(p.path for p in found if not (p.utf8 or p.legacy))
    if bad:
        raise ValueError(f"neither {UTF8} nor {legacy}: {', '.join(bad[:5])}" + (f" and {len(bad) - 5} more" if len(bad) > 5 else ""))
    return found


def _decoded(line: str, charset: str) -> Column:
    """A line read as text, decoded from its bytes (a byte sequence that is no character becomes U+FFFD)."""
    return F.col(line) if charset == UTF8 else F.decode(F.col(line).cast("binary"), charset)


def decodes(line: str, charset: str) -> Column:
    """Whether the bytes of a line are text in a charset. A line that holds U+FFFD itself is valid UTF-8."""
    return _valid(F.col(line).cast("binary"), charset)


def detect_encodings(
    spark: SparkSession, paths: str | Sequence[str], legacy: str = DEFAULT_LEGACY_ENCODING
) -> dict[str, str]:
    """File path -> charset: UTF-8 when every line decodes, else ``legacy`` when every line does."""
    return {p.path: p.charset(legacy) for p in file_profiles(spark, paths, legacy)}


def read_csv_layouts(
    spark: SparkSession,
    paths: str | Sequence[str] | Sequence[CsvLayout],
    encoding: str = "auto",
    legacy_encoding: str = DEFAULT_LEGACY_ENCODING,
    per_layout: Callable[[DataFrame], DataFrame] | None = None,
    single_layout: bool = False,
) -> DataFrame:
    """Read CSV files with differing headers and/or charsets into one frame.

    ``encoding='auto'`` detects UTF-8 vs ``legacy_encoding`` per file; any other
    value is used for every file. ``per_layout`` (e.g. a parser that resolves
    candidate column names) runs on each layout group **before** the union, so
    every group is resolved against its own header. Without it, columns missing
    from a layout are NULL in the union.

    With :class:`CsvLayout` entries as ``paths``, each is read in one strict pass and
    nothing is profiled. ``single_layout=True`` (with an explicit ``encoding``) says the
    same of plain paths.
    """
    if single_layout:
        if encoding == "auto":
            raise ValueError("single_layout=True needs an explicit encoding")
        paths = [CsvLayout(p, encoding) for p in ([paths] if isinstance(paths, str) else paths)]
    if not isinstance(paths, str) and any(isinstance(p, CsvLayout) for p in paths):
        frames = [read_csv_strings(spark, p.path, p.encoding, strict=True) for p in paths]
    else:
        profiles = file_profiles(spark, paths, legacy_encoding)
        if not profiles:
            raise ValueError(f"no input files under {paths!r}")
        groups: dict[tuple[str, str], list[str]] = {}
        for p in profiles:
            charset = p.charset(legacy_encoding) if encoding == "auto" else encoding
            groups.setdefault((charset, p.header), []).append(p.path)
        frames = [read_csv_strings(spark, sorted(files), charset) for (charset, _), files in sorted(groups.items())]
    if per_layout is not None:
        frames = [per_layout(f) for f in frames]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def normalize_to_utf8(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    legacy_encoding: str = DEFAULT_LEGACY_ENCODING,
) -> list[str]:
    """Rewrite text files as UTF-8 (S8), line by line: cells, blanks, quotes and ragged
    rows stay as they are; lines of nothing but blanks, which no CSV reader sees, are left out. Each (charset, header) group goes to ``output/layout=<i>``; every
    written part begins with the group's header line, so parts are files of their own. A file that is
    valid in neither charset is an error before anything is written. Returns the written
    folders. Runs as Spark jobs; no file passes the driver."""
    profiles = file_profiles(spark, paths, legacy_encoding)
    groups: dict[tuple[str, str], list[str]] = {}
    for p in profiles:
        groups.setdefault((p.charset(legacy_encoding), p.header), []).append(p.path)
    written = []
    for i, ((charset, _), files) in enumerate(sorted(groups.items())):
        target = f"{output.rstrip('/')}/layout={i}"
        header = spark.read.text(files[0]).select(_decoded("value", charset).alias("value")).first()["value"]
        # the reader leaves out each file's header line, the writer puts one into each part
        lines = spark.read.schema("value string").options(header=True, enforceSchema=True, encoding=_BYTES, **_WHOLE_LINES).csv(sorted(files))
        raw = F.encode("value", _BYTES)  # each byte is one character there, so the file's bytes come through
        lines.select(F.decode(raw, charset).alias(header)).write.mode("overwrite").options(header=True, escapeQuotes=False, **_WHOLE_LINES).csv(target)
        written.append(target)
    return written


#: a line as one cell: a separator that no line holds, no quotes, no trimming
_WHOLE_LINES = {
    "sep": "\u0001\u0002\u0001", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "", "nullValue": "\u0002\u0003",
}


def resolve_columns(columns: Sequence[str], wanted: dict, optional: Iterable = ()) -> dict:
    """Names of an input's columns for what a parser wants.

    ``wanted`` maps each key to the names it may have, best first. The result maps the
    keys found to the names present. What is missing and not ``optional`` is
    reported in one error, before any job runs (Q2)."""
    present = set(columns)
    found = {key: next((n for n in names if n in present), None) for key, names in wanted.items()}
    missing = {key: list(wanted[key]) for key, name in found.items() if name is None and key not in set(optional)}
    if missing:
        listed = "; ".join(f"{key} ({' or '.join(names)})" for key, names in missing.items())
        raise ValueError(f"the input has no column for: {listed}. It has: {', '.join(columns)}")
    return {key: name for key, name in found.items() if name is not None}


def source_bytes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Total size of the input files (S10), without reading their content: only the
    ``length`` column of the binary-file source is selected."""
    files = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes")
    )


def require_min_bytes(spark: SparkSession, paths: str | Sequence[str], min_bytes: int) -> int:
    """Raise unless the inputs hold at least ``min_bytes`` bytes; returns the total."""
    total = source_bytes(spark, paths).first()["bytes"]
    if total < min_bytes:
        raise ValueError(f"input too small: {total} bytes < required {min_bytes}")
    return total
