"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import hashlib
import math
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are written for.  Memory is the cluster's business: AQE merges small
# partitions and splits skewed ones at run time, and ``size_shuffles`` raises the number it starts with.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "salescompass", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session whose one process does all the work (``local[n]``) may go without: it gets a
    folder of its own, and the setting then names it.  ``use_local_dir`` lets the caller choose.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return use_local_dir(spark, tempfile.mkdtemp(prefix="salescompass-"))


def use_local_dir(spark: SparkSession, path: str) -> str:
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, *parts: str) -> str:
    """Sub-folder of the shared folder that belongs to this application."""
    app = spark.sparkContext.applicationId
    return "/".join([shared_dir(spark), "salescompass", app, *parts])


SOURCE_BYTES = 16_000_000  # bytes of the given files for each partition that a shuffle starts with
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, source_dir: str) -> None:
    """Let shuffles start with partitions in proportion to the given files, if that is more than are set.

    With a fixed number a task's share, and what it sorts or spills, grows with the input.  AQE merges
    the partitions that turn out small.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(source_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    wanted = math.ceil(files.getContentSummary(folder).getLength() / SOURCE_BYTES)
    if wanted > int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    """Inside, the shuffle files of a job go when it ends.

    Else they go once the driver has collected the last reference to them, which a driver with memory
    to spare does not get to, so those of one table after the other would fill the disk.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def digest(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()[:12]
