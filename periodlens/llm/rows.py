"""Row identity and staging for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.session import staging_path
from periodlens.sinks import delete_path


_STAGED: list[str] = []


def staged() -> frozenset[str]:
    """The tables staged so far."""
    return frozenset(_STAGED)


def discard_staged(spark: SparkSession, but: frozenset[str] = frozenset(), keep: int = 0) -> None:
    """Remove what was staged, but for the tables in ``but`` and the last ``keep`` ones: for when results that
    read it are written."""
    old = [p for p in _STAGED[: len(_STAGED) - keep] if p not in but]
    for path in old:
        _STAGED.remove(path)
        delete_path(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Hand at most 4 MB at a time to Python (Spark's own bound is 64 MB, twice or more of that in a worker)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def stage(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs don't depend on its lineage."""
    path = staging_path(spark, name)
    _STAGED.append(path)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def column(frame: DataFrame, name: str) -> F.Column:
    """A column by exact name (also with dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _is_file_scan(frame: DataFrame) -> bool:
    """Whether a frame is one file relation under column selections only, so that each of its rows is a row of a file."""
    node = getattr(frame, "_jdf", None)
    if node is None:  # a session without a JVM at hand
        return False
    node = node.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "SubqueryAlias"):
        if not node.deterministic():
            return False
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation" and node.relation().getClass().getSimpleName() == "HadoopFsRelation"


def with_row_key(spark: SparkSession, frame: DataFrame, name: str = "rows") -> DataFrame:
    """Add ``_f``, ``_r``: a key of each row, the same in every job.

    It is the file's path (hashed) and the row's index there, so repeated rows and
    repeated or null ids stay apart. A frame that isn't a plain file scan (filtered, exploded, joined, limited ...)
    is staged first: there a file's row may stand for several rows or none, and another job may see other rows."""
    bounded_batches(spark)
    if not _is_file_scan(frame):
        frame = stage(spark, frame, name)
    return frame.select("*", F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))
