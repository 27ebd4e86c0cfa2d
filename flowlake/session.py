"""Session helpers: a tuned local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that one round of a step done in rounds takes, at most (by even hashes).
ROUND_ROWS = 25_000_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "flowlake", extra_conf: dict | None = None) -> SparkSession:
    """Session with the settings every operator here assumes.

    AQE coalesces small shuffles and splits skewed join partitions at run time;
    the session time zone is pinned to UTC so timestamp casts are stable.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only behind a size check: the planner's estimate (static)
        # and the measured shuffle size (AQE); larger sides are shuffled
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # top-k above this many rows plans as a distributed sort + limit instead
        # of one in-memory priority queue per task sized to the limit
        .config("spark.sql.execution.topKSortFallbackThreshold", "1000000")
        # checkpoint files of the ordered operators are removed once their
        # DataFrames are garbage collected (long-lived sessions do not pile up)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("FLOWLAKE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(sc) -> bool:
    """Whether driver and executors are one process."""
    return sc.master == "local" or sc.master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; only in local mode, where one machine runs all
    tasks, a folder of our own is set when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="flowlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes in this block leave no shuffle files behind; nothing reads them again."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, was) if was else spark.conf.unset(SHUFFLE_CLEANUP)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps read files, not the work above them."""
    return written_in_rounds([df], label)


def written_in_rounds(frames: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all ``frames`` (of one schema), written one frame after the other: disk holds the shuffles of one at a time."""
    path = None
    for df in frames:
        path = path or shared_path(df.sparkSession, label)
        with shuffles_dropped(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``written`` has returned, once nothing reads it any more."""
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def rounds(rows: int) -> int:
    """Rounds that a step over so many rows takes."""
    return 1 + max(0, rows - 1) // ROUND_ROWS


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so their Python workers can import it.

    Needed wherever the driver found it by its own ``sys.path``; in local mode
    the workers see the driver's files and nothing is sent.
    """
    sc = spark.sparkContext
    if is_local(sc):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(
                p for p in (root, sc.environment.get("PYTHONPATH"), os.environ.get("PYTHONPATH")) if p)
        return
    if getattr(sc, "_flowlake_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="flowlake-package-"), "flowlake")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    sc._flowlake_shipped = True
