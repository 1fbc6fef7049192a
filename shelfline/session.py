"""Session construction and the shared scratch location.

Materialised intermediate tables (the loaded star schema, checkpoints) go to
the folder the cluster names in ``spark.checkpoint.dir``. Only a local master
may do without that setting: it then uses a private folder under the system
temp dir, registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None
#: The files of a query's shuffles go when the query ends, not when the driver's JVM next collects garbage.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_HELD: dict[tuple[int, str], tuple[int, str | None]] = {}
_HELD_LOCK = threading.Lock()


def get_session(master: str | None = None, app: str = "shelfline",
                shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session tuned for star-schema work.

    Master, shuffle partitions and driver memory are set only if the caller
    names them: a submitted job keeps those of its cluster. AQE coalesces the
    many small post-shuffle partitions of dimension joins and splits skewed
    ones; the broadcast threshold stays at a fixed byte size so only
    dimension-sized sides are broadcast.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (("spark.master", master), ("spark.sql.shuffle.partitions", shuffle_partitions),
                       ("spark.driver.memory", driver_memory)):
        if value is not None:
            builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem) or a checkpoint dir set on the context; without either, a
    session on a cluster raises an error instead of writing to one machine's
    disk. A local session registers a folder under the temp dir; it is stable
    per user so separate local processes reuse the loaded star schema instead
    of rebuilding it.
    """
    global _LOCAL_SCRATCH
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = os.path.join(tempfile.gettempdir(), f"shelfline-scratch-{os.getuid()}")
        os.makedirs(_LOCAL_SCRATCH, exist_ok=True)
    sc.setCheckpointDir(_LOCAL_SCRATCH)
    return _LOCAL_SCRATCH


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` hold for the queries made inside, then the session's own again.

    Threads and nested uses share a setting: the last to leave puts back what the first found."""
    with _HELD_LOCK:
        for k, v in settings.items():
            users, before = _HELD.get((id(spark), k)) or (0, spark.conf.get(k, None))
            _HELD[id(spark), k] = users + 1, before
            if not users:
                spark.conf.set(k, v)
    try:
        yield
    finally:
        with _HELD_LOCK:
            for k in settings:
                users, before = _HELD.pop((id(spark), k))
                if users > 1:
                    _HELD[id(spark), k] = users - 1, before
                elif before is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, before)


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local``, ``local[4]``), unlike ``local-cluster``."""
    return master == "local" or master.startswith("local[")
