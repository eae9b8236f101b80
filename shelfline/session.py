"""Session settings and the shared folder."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import threading
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

STORED = "zstd"    # compression of what stays: some two thirds of the default's size
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": "UTC", **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local session without that setting falls back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="shelfline-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/shelfline/{name}-{uuid.uuid4().hex[:12]}"


_writing: dict[str, list] = {}    # by session: how many are under way, and what was set before the first of them
_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of the writes and collects started inside go as each of them ends. Those of several threads may
    overlap; what was set before holds again after the last of them."""
    conf, key = spark.conf, spark._jsparkSession.sessionUUID()
    with _lock:
        _writing.setdefault(key, [0, conf.get(SHUFFLE_CLEANUP, None)])[0] += 1
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writing[key][0] -= 1
            if not _writing[key][0]:
                before = _writing.pop(key)[1]
                conf.set(SHUFFLE_CLEANUP, before) if before is not None else conf.unset(SHUFFLE_CLEANUP)


def freeze(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes a frame to the shared folder, or to `path`, and reads it back.

    This cuts its lineage and fixes what could come out differently on a second evaluation. The
    files outlive any executor, and later reads take only the columns they need. The write's shuffle
    files go when it ends; nothing else reads them.
    """
    path = path or run_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    frozen = df.sparkSession.read.schema(df.schema).parquet(path)
    frozen._frozen_at = path
    return frozen


def discard(*frames: DataFrame | None) -> None:
    """Deletes tables made by `freeze`. Only for those that nothing reads any more, not even to make up for a lost
    executor: all that came from them has to be frozen itself. Other frames are left alone."""
    for df in frames:
        if path := getattr(df, "_frozen_at", None):
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def remove_old_runs(spark: SparkSession, older_than: dt.timedelta) -> int:
    """Deletes folders made by `run_dir` that have not changed for so long; returns how many."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/shelfline")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    limit = (time.time() - older_than.total_seconds()) * 1000
    old = [s.getPath() for s in fs.listStatus(path) if s.getModificationTime() < limit]
    for folder in old:
        fs.delete(folder, True)
    return len(old)
