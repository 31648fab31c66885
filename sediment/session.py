"""Session construction and shared scratch space.

Scratch data (written tables that cut lineage, landing files produced by the engine) always
lives under the folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is absent (local runs, tests) do we create our own folder and register it as the checkpoint
directory, so ``DataFrame.checkpoint()`` and our written tables share one root.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every session of the engine wants; sizes are for the shuffle-heavy silver joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast decisions use sizes AQE has measured on materialized shuffles, never planner
    # estimates: static auto-broadcast is off, the runtime threshold is explicit.  Explicit
    # broadcast() is used only where the size is bounded by construction (a top-k).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Shuffle partitions: AQE coalesces small ones and splits skewed ones toward this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "sediment", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` is only set when given; on a cluster the launcher provides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    # Runtime SQL confs also apply to a session that already existed.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the URI the cluster gave.

    Only a local master may do without the setting: then a folder of this machine is made and
    registered.  On a cluster executors would not see such a folder, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sediment-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for a table written by the engine."""
    return f"{checkpoint_root(spark)}/sediment/{name}-{uuid.uuid4().hex[:12]}"


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, str]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes, and actions on frames made inside, delete their shuffle files as they end; else these
    stay until the driver happens to collect its garbage, and those of all layers add up on disk.

    Threads of one session may be inside at once; the last one to leave restores the setting.  A plan
    that is run again all the same computes its shuffles anew.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, former = _dropping.get(session) or (0, spark.conf.get(DROP_SHUFFLES, "false"))
        _dropping[session] = inside + 1, former
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            inside, former = _dropping.pop(session)
            if inside > 1:
                _dropping[session] = inside - 1, former
            else:
                spark.conf.set(DROP_SHUFFLES, former)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; a refused rename is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of this engine through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
