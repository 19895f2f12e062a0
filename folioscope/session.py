"""Session helpers: a tuned builder for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


_SCRATCH: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.folioscope.spread", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver
    and executors are one process, may fall back to a temporary folder, which goes when
    the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="folioscope-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for :func:`remove_scratch` to remove."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Remove what is at the paths handed out so far; call it when their results are used."""
    context = spark.sparkContext
    while _SCRATCH:
        folder = context._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
