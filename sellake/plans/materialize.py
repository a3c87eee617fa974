"""Silver/Gold boundaries written as tables in the session's shared checkpoint folder.

A layer is written once per (source files, as-of date, library code version)
and read back by every later query, so reports run on the Gold tables instead
of recomputing the whole chain. A table is written to a folder of its own and published by a
marker file that names it; readers follow the marker, so a half-written folder is
never read and no rename is needed. The written table also cuts the lineage (executor loss replays
from the table, not from the raw sources).
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..session import TASK_SHUFFLE_BYTES, bounded_tasks, checkpoint_dir
from ..sources.tables import DRIVER_TABLES

_LOCK = threading.Lock()
_LOCKS: dict[str, threading.Lock] = {}


def _code_version() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode())
                    h.update(fh.read())
    return h.hexdigest()[:16]


CODE_VERSION = _code_version()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def table(spark: SparkSession, key: str, name: str, build: Callable[[], DataFrame],
          prepare: Callable[[DataFrame], DataFrame] | None = None, source_size: int = 0, task_bytes: int = TASK_SHUFFLE_BYTES) -> DataFrame:
    """The table ``name`` of the layer set ``key``: read it if published, else build, write (in tasks bounded by the size of the
    sources and ``task_bytes``), publish, read."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/sellake-tables/{CODE_VERSION}/{key}"
    marker = f"{base}/{name}.published"
    with _LOCK:
        lock = _LOCKS.setdefault(marker, threading.Lock())
    with lock:
        fs, p, _ = _fs(spark, marker)
        if not fs.exists(p):
            df = build()
            if prepare is not None:
                df = prepare(df)
            path = f"{base}/{name}-{uuid.uuid4().hex}"
            with bounded_tasks(spark, source_size, task_bytes):
                df.write.parquet(path, compression="zstd")
            try:
                out = fs.create(p, False)
                out.writeUTF(path)
                out.close()
            except Py4JJavaError:  # another writer has published it meanwhile
                if not fs.exists(p):
                    raise
        stream = fs.open(p)
        path = stream.readUTF()
        stream.close()
        return spark.read.parquet(path)


def _source_files(spark: SparkSession, sf_dir: str, name: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files of a source table."""
    fs, p, _ = _fs(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    found = []
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
    return sorted(found)


def layer_key(spark: SparkSession, sf_dir: str, as_of: str) -> str:
    """Digest of the source files (path, length, modification time) and the as-of date: new data makes new layers."""
    h = hashlib.sha256(as_of.encode())
    for name in DRIVER_TABLES:
        h.update("\n".join(f"{p}|{n}|{t}" for p, n, t in _source_files(spark, sf_dir, name)).encode())
    return h.hexdigest()[:32]


#: The tables whose rows the layers are made of.
SIZED = ("customer", "supplier", "part", "orders", "lineitem", "events")


def source_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the source files that layers are made of."""
    return sum(n for name in SIZED for _, n, _ in _source_files(spark, sf_dir, name))
