"""Session defaults. Operators never touch the session; they only build plans."""

from __future__ import annotations

import os
import shutil
import tempfile
import weakref

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def local_session(cpus: int = 8, app: str = "tidewatch", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster, pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a skewed join partition even when that costs one more exchange downstream.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh temporary one only where it is unset on a local master."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), name)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so functions that run there can import it.

    Spark serves the archive from the driver; executors need no folder in common for it.
    """
    if spark.sparkContext in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidewatch-ship-")
    archive = shutil.make_archive(
        os.path.join(folder, "tidewatch"), "zip", root_dir=os.path.dirname(here), base_dir=os.path.basename(here)
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext)
