"""Session helpers: configuration that the library relies on."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that the results depend on (wall-clock timestamps, ANSI arithmetic).
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Settings that keep plans scalable (AQE coalescing / skew handling).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # routed writes keep their two destinations' files open instead of sorting the table by destination
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}
REQUIRED_CONF = {**RESULT_CONF, **PLAN_CONF}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "mercato", conf: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library depends on to an existing session.

    Raises when a setting that results depend on cannot be made.
    """
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    wrong = {k: spark.conf.get(k, None) for k, v in RESULT_CONF.items() if spark.conf.get(k, None) != v}
    if wrong:
        raise RuntimeError(f"the session keeps {wrong}; results need {RESULT_CONF}")
    return spark


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}   # session -> how many blocks are open, and the setting before the first of them
_cleaning_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver's JVM next collects its plan.

    For writes: a write runs once.  A DataFrame that is run a second time would
    have to make its shuffles again, so the session's setting stays as it was
    outside.  Blocks may overlap in several threads.
    """
    key = spark._jsparkSession.sessionUUID()
    with _cleaning_lock:
        here = _cleaning.setdefault(key, [0, spark.conf.get(CLEANUP, None)])
        here[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            here[0] -= 1
            if not here[0]:
                before = _cleaning.pop(key)[1]
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required: executors could not see each
    other's files in a machine-local folder.  Only a session whose driver
    and executors are one process gets a fresh local folder when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="mercato-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table under the shared folder, deleted when the driver ends."""
    where = os.path.join(checkpoint_dir(spark), name)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return where
