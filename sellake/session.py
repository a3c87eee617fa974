"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on: AQE re-plans joins and partition counts from
# runtime sizes (and splits skewed shuffle partitions), UTC session time, and
# dynamic partition overwrite for incremental table writes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}
# Local runs: the driver JVM is the only executor, so it needs the memory.
LOCAL_CONF = {"spark.driver.memory": os.environ.get("SELLAKE_LOCAL_MEMORY", "8g")}
_LOCAL_DIRS: dict[str, str] = {}


def get_spark(master: str | None = None, app: str = "sellake", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_CONF.items():
                b = b.config(k, v)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# --- Fixed values: size of a task of a layer's writing job ---
TASK_SHUFFLE_BYTES = 32 << 20      # shuffled bytes that a task reads
SOURCE_BYTES_A_PARTITION = 2 << 20  # source files' bytes for each shuffle partition (a byte of them makes some 8 shuffled ones in the sales chain)
BUILD_SIDE_BYTES = 64 << 20        # largest partition of a join's smaller side that is hashed instead of sorted
_SCOPES: dict[int, list] = {}
_SCOPES_LOCK = threading.Lock()


def _bytes(text: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    t = text.strip().lower().removesuffix("b")
    return int(t[:-1]) << units[t[-1]] if t[-1:] in units else int(t)


@contextmanager
def bounded_tasks(spark: SparkSession, source_bytes: int, task_bytes: int = TASK_SHUFFLE_BYTES):
    """Settings under which a job's tasks stay small however large the sources are, so that sorts do not spill: more partitions for more
    input, at most ``task_bytes`` (32 MB) shuffled to a task, and joins whose smaller side is small in every partition hash it and leave the lines unsorted (AQE decides by
    measured sizes). The caller's settings come back afterwards; jobs that overlap in one session share the scope."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    names = ["spark.sql.shuffle.partitions", size, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]
    with _SCOPES_LOCK:
        scope = _SCOPES.setdefault(id(spark), [0, {}])
        if not scope[0]:
            scope[1] = {n: spark.conf.get(n, None) for n in names}
            # a session that sets none of them is under Spark's defaults: asked for without one of our own, these are given
            partitions = max(int(spark.conf.get(names[0])), -(-source_bytes // SOURCE_BYTES_A_PARTITION))
            target = min(_bytes(spark.conf.get(size)), task_bytes)
            for n, v in zip(names, (partitions, target, BUILD_SIDE_BYTES)):
                spark.conf.set(n, str(v))
        scope[0] += 1
    try:
        yield
    finally:
        with _SCOPES_LOCK:
            scope[0] -= 1
            if not scope[0]:
                for n, v in scope[1].items():
                    spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session in ``spark.checkpoint.dir``.

    On a cluster it must be set: a machine-local folder would give each executor files that the others cannot see. A
    ``local`` master is one machine, so there, and only there, an unset folder is replaced by a new temporary one.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="sellake-ckpt-")
    return _LOCAL_DIRS[sc.applicationId]
