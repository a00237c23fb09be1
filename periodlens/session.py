"""Session settings and shared-storage locations.

The library never creates its own cluster settings beyond what it needs for
correct results:

* ``spark.sql.legacy.javaCharsets=true`` lets the CSV reader decode CP949/EUC-KR
  (Spark 4 only accepts a short list of charsets otherwise).
* AQE (on by default in Spark 4) stays on: it coalesces the small shuffles of the
  report aggregations and splits skewed partitions of a fact-to-dimension join.

Staging data (CSV round trips, checkpoints) goes to the folder named by
``spark.checkpoint.dir``, which a cluster points at shared storage. Only when the
setting is absent and the master is local (local runs, tests) is a local folder
chosen (one per session) and registered with ``setCheckpointDir``; the conf
itself is never changed at run time (Spark rejects it). On a cluster a missing
setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

_CONF_CHECKPOINT = "spark.checkpoint.dir"

REQUIRED_CONF = {
    "spark.sql.legacy.javaCharsets": "true",
    # bytes that are no character become U+FFFD, which the CSV readers look for (and name the file)
    "spark.sql.legacy.codingErrorAction": "true",
    # literal dimension tables are shipped through Arrow as LocalRelations
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # joins are left to AQE, which sees real sizes and splits skewed partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # call-site capture on every PySpark call (error context) costs a JVM round
    # trip per expression when plans are built; off for benchmarks and tests
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "periodlens") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PERIODLENS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except PySparkAttributeError:
        return None


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set up locally only if unset.

    Read from ``spark.checkpoint.dir`` (session or application conf), else from a
    checkpoint folder already registered on the SparkContext. When none exists and
    the master is local, one temporary folder per session is created and
    registered with ``setCheckpointDir`` (the conf itself cannot be changed at run
    time); on a cluster a missing setting is an error."""
    sc = _context(spark)
    current = spark.conf.get(_CONF_CHECKPOINT, None)
    if sc is not None:
        current = current or sc.getConf().get(_CONF_CHECKPOINT, None) or sc.getCheckpointDir() or _LOCAL_DIRS.get(sc.applicationId)
    if not current:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: point it at a folder on shared storage "
                "(a machine-local folder is not visible to every executor)"
            )
        current = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="periodlens-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
